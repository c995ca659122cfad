"""A Merkle manifest of a dataset, and octopus multiproofs of its leaves.

Every row is a leaf of its group's tree; the subroots, in the order of the groups, are the leaves of the top tree.
Runs of ``ARITY`` consecutive nodes become one node of the next level. Nodes have coordinates (tree, level, at), the
top tree being number ``TOP``.

Proofs are made for many leaves at once. A partition of leaves (one stretch of a tree) computes the minimal set of
coordinates that it lacks: the nodes beside its paths that none of its own leaves imply. It fetches each of them
once, derives every interior node that its leaves share, up to the root, and expands the single proofs locally.
"""

import hashlib
from collections import defaultdict
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tellerlake.llm.tables import store, table

ARITY = 16
#: Levels that one partition of leaves spans: 16 ** 3 leaves of about a hundred bytes.
SPAN = 3
TOP = -1
#: Partitions that read one copy of a stored node; nodes that more of them lack are copied for the join.
READERS = 1024
#: Columns of a leaf, in order (fixed values).
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_PLACES = 33  # of monotonically_increasing_id: the bits that count rows of a task


def leaf(**changed: str) -> str:
    """SQL of a row's leaf digest, in binary; ``changed`` gives the SQL of fields that are not as they are stored."""
    parts = []
    for name in FIELDS:
        value = f"CAST({changed.get(name, name)} AS STRING)"
        parts.append(f"COALESCE(CONCAT(CAST(OCTET_LENGTH({value}) AS STRING), ':', {value}), '-')")
    return f"UNHEX(SHA2(CONCAT({', '.join(parts)}), 256))"


def _hash(digests) -> bytes:
    """H of digests as hex text, in binary."""
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def ranked(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` stored in that order, with their dense place in it as column ``name``.

    The order is a range partitioning of sampled bounds; each write task counts its rows, and the running totals
    (one row a task) are all that meets in one place. Rows that are equal in ``order`` may come in any order.
    """
    number = F.monotonically_increasing_id()
    placed = store(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", number))
    task = F.shiftright("_id", _PLACES)
    sizes = placed.groupBy(task.alias("_task")).agg(F.count("*").alias("_n"))
    before = sizes.select("_task", (F.sum("_n").over(Window.orderBy("_task")) - F.col("_n")).alias("_before"))
    mine = placed.withColumn("_task", task).join(F.broadcast(before), "_task")
    place = F.col("_id") - F.shiftleft("_task", _PLACES) + F.col("_before")
    return mine.withColumn(name, place).drop("_id", "_before")


def _climb(nodes: DataFrame, level: int, height: int) -> list[DataFrame]:
    """The levels above ``nodes`` (tree, at, digest, trees with one node finished), stored, one frame a level."""
    levels = []
    for above in range(level + 1, height + 1):
        runs = nodes.groupBy("tree", F.shiftright("at", 4).alias("at")).agg(
            F.sort_array(F.collect_list(F.struct("at", "digest"))).alias("run"), F.first("size").alias("size")
        )
        text = "CONCAT_WS('', TRANSFORM(run, node -> LOWER(HEX(node.digest))))"
        nodes = store(runs.selectExpr("tree", f"{above} AS level", "at", f"UNHEX(SHA2({text}, 256)) AS digest", "size"))
        levels.append(nodes)
        nodes = nodes.where(f"size > POW({ARITY}, {above})")
    return levels


def height_of(size: int) -> int:
    """Levels above the leaves of a tree."""
    levels = 0
    while size > 1:
        size = -(-size // ARITY)
        levels += 1
    return levels


def width(size: int, level: int) -> int:
    """Nodes on a level of a tree with ``size`` leaves."""
    return -(-size // ARITY**level)


def lacking(wanted: list[int], size: int) -> list[tuple[int, int]]:
    """Coordinates (level, at) beside the paths of the ``wanted`` leaves that these leaves don't imply.

    One pass a level: runs that hold a known node are needed whole, and become the known nodes of the next level.
    """
    missing, known = [], sorted(set(wanted))
    for level in range(height_of(size)):
        nodes, held = width(size, level), set(known)
        known = sorted({at // ARITY for at in known})
        for run in known:
            missing += [(level, at) for at in range(run * ARITY, min((run + 1) * ARITY, nodes)) if at not in held]
    return missing


def derive(nodes: dict[tuple[int, int], bytes], wanted: list[int], size: int) -> None:
    """Add to ``nodes`` (level, at) every interior node on the paths of ``wanted``, the root included."""
    known = sorted(set(wanted))
    for level in range(height_of(size)):
        last = width(size, level)
        known = sorted({at // ARITY for at in known})
        for run in known:
            run_of = range(run * ARITY, min((run + 1) * ARITY, last))
            nodes[level + 1, run] = _hash(nodes[level, at] for at in run_of)


def path(nodes: dict[tuple[int, int], bytes], at: int, size: int) -> list[tuple[list[str], list[str]]]:
    """Siblings before and after the path of one leaf, as hex text, level by level."""
    steps = []
    for level in range(height_of(size)):
        first, last = at // ARITY * ARITY, width(size, level)
        run = [nodes[level, other].hex() for other in range(first, min(first + ARITY, last))]
        steps.append((run[: at - first], run[at - first + 1 :]))
        at //= ARITY
    return steps


def fold(digest: bytes, steps) -> bytes:
    """The root that a leaf and its siblings give."""
    for before, after in steps:
        digest = hashlib.sha256("".join([*before, digest.hex(), *after]).encode()).digest()
    return digest


@dataclass(frozen=True)
class Manifest:
    """The stored trees over the rows of a table.

    ``leaves`` has (tree, at, doc_id, source, digest, altered, size). ``levels`` and ``top`` hold the nodes of the
    sources' trees and of the top tree, one frame (tree, level, at, digest, size) a level from the leaves up.
    ``sources`` is the number of subroots, ``root`` the hex text of the root.
    """

    leaves: DataFrame
    levels: list[DataFrame]
    top: list[DataFrame]
    sources: int
    root: str


def build(docs: DataFrame, tampered: str = "NULL") -> Manifest:
    """The manifest of ``docs`` (doc_id, source, lang, n_chars, text), its other columns ignored.

    ``tampered`` is SQL of the text that a tampered row has, null where a row is left alone. Per source, rows
    without doc_id come first; rows of equal doc_id are ordered by their digests, equal rows are equal leaves. Any
    field may be null; texts may be empty or of any length. Of an empty table the root is the digest of nothing.
    """
    docs = docs.select(*FIELDS)
    other = f"CASE WHEN {tampered} IS NOT NULL THEN {leaf(text=tampered)} END"
    slim = store(docs.selectExpr("doc_id", "source", f"{leaf()} AS digest", f"{other} AS altered"))
    in_order = [F.asc_nulls_first("source"), F.asc_nulls_first("doc_id"), F.asc("digest")]
    # Equal rows differ by their place in the file only, which keeps many copies of one from sharing a task.
    slim = slim.withColumn("_file_place", F.monotonically_increasing_id())
    rows = ranked(slim, [*in_order, F.asc("_file_place")], "place")

    # A source's rows are consecutive: its first place and its size give every row its place in the tree. The join
    # is by source and task, so a source with a third of the rows is as many keys as tasks wrote it.
    stretches = rows.groupBy("source", "_task").agg(F.min("place").alias("low"), F.count("*").alias("n"))
    sources = stretches.groupBy("source").agg(F.min("low").alias("first"), F.sum("n").alias("size"))
    sources = store(ranked(sources, [F.asc_nulls_first("source")], "tree").drop("_task"))
    n_sources, most = sources.agg(F.count("*"), F.coalesce(F.max("size"), F.lit(0))).first()
    of_task = stretches.join(sources.withColumnRenamed("source", "_source"), F.expr("source <=> _source")).select(
        F.col("source").alias("_source"), F.col("_task").alias("_of"), "tree", "first", "size"
    )
    leaves = store(
        rows.join(of_task, F.expr("source <=> _source AND _task = _of")).selectExpr(
            "tree", "place - first AS at", "doc_id", "source", "digest", "altered", "size"
        )
    )

    def summits(stretch: pa.Table) -> pa.Table:
        """Interior nodes of the SPAN lowest levels over one partition of leaves."""
        stretch = stretch.sort_by("at")
        tree, size, start = (stretch.column(name)[0].as_py() for name in ("tree", "size", "at"))
        known, out = stretch.column("digest").to_pylist(), []
        for level in range(1, min(SPAN, height_of(size)) + 1):
            known = [_hash(known[i : i + ARITY]) for i in range(0, len(known), ARITY)]
            out += [(tree, level, (start >> 4 * level) + i, digest, size) for i, digest in enumerate(known)]
        names = ["tree", "level", "at", "digest", "size"]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64()]
        columns = zip(*out) if out else [()] * len(names)
        return pa.table([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)

    chunk = F.shiftright("at", 4 * SPAN).alias("chunk")
    node = "tree long, level int, at long, digest binary, size long"
    low = store(leaves.select("tree", "at", "digest", "size").groupBy("tree", chunk).applyInArrow(summits, node))
    middle = _climb(low.where(f"level = {SPAN} AND size > {ARITY**SPAN}"), SPAN, height_of(most))
    levels = [leaves.selectExpr("tree", "0 AS level", "at", "digest", "size")]
    levels += [low.where(f"level = {level}") for level in range(1, min(SPAN, height_of(most)) + 1)]
    levels += middle

    crowns = levels[0].where("size = 1")
    for level, frame in enumerate(levels[1:], 1):
        crowns = crowns.union(frame.where(f"size > {ARITY ** (level - 1)} AND size <= {ARITY**level}"))
    subroots = store(crowns.selectExpr(f"{TOP}L AS tree", "0 AS level", "tree AS at", "digest", f"{n_sources}L AS size"))
    top = [subroots, *_climb(subroots, 0, height_of(n_sources))]
    peak = top[-1].first()
    root = peak.digest.hex() if peak else _hash(()).hex()
    return Manifest(leaves, levels, top, n_sources, root)


def prove(manifest: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """Proofs of the ``wanted`` leaves, rows of ``manifest.leaves``; of all without it.

    Returns doc_id, source, leaf, subroot, root, proof_sha256, folded_root, verified, one row a leaf, repeated rows
    repeated; no leaves give no rows.
    """
    wanted = manifest.leaves if wanted is None else store(wanted)
    n_sources, root = manifest.sources, manifest.root

    def lacks(stretch: pa.Table) -> pa.Table:
        """What one partition of leaves has to fetch: of its tree, then of the top tree."""
        tree, size, chunk = (stretch.column(name)[0].as_py() for name in ("tree", "size", "chunk"))
        found = [(tree, chunk, tree, *c) for c in lacking(stretch.column("at").to_pylist(), size)]
        found += [(tree, chunk, TOP, *c) for c in lacking([tree], n_sources)]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        columns = zip(*found) if found else [()] * len(types)
        names = ["for_tree", "for_chunk", "tree", "level", "at"]
        return pa.table([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)

    def expand(mine: pa.Table, fetched: pa.Table) -> pa.Table:
        tree, size = mine.column("tree")[0].as_py(), mine.column("size")[0].as_py()
        places, digests = mine.column("at").to_pylist(), mine.column("digest").to_pylist()
        nodes, top = {(0, at): digest for at, digest in zip(places, digests)}, {}
        for of, level, at, digest in zip(*(fetched.column(n).to_pylist() for n in ("tree", "level", "at", "digest"))):
            (top if of == TOP else nodes)[level, at] = digest
        derive(nodes, places, size)
        top[0, tree] = nodes[height_of(size), 0]
        derive(top, [tree], n_sources)
        beyond = path(top, tree, n_sources)
        out = defaultdict(list)
        for at, digest, altered in zip(places, digests, mine.column("altered").to_pylist()):
            steps = path(nodes, at, size) + beyond
            proof = hashlib.sha256("".join("".join(before + after) for before, after in steps).encode())
            folded = fold(altered or digest, steps).hex()
            out["leaf"].append(digest.hex())
            out["subroot"].append(top[0, tree].hex())
            out["root"].append(root)
            out["proof_sha256"].append(proof.hexdigest())
            out["folded_root"].append(folded)
            out["verified"].append(folded == root)
        return pa.table({"doc_id": mine.column("doc_id"), "source": mine.column("source"), **out})

    chunk = F.shiftright("at", 4 * SPAN).alias("chunk")
    coordinate = "for_tree long, for_chunk long, tree long, level int, at long"
    asked = store(
        wanted.select("tree", "at", "size", chunk).groupBy("tree", "chunk").applyInArrow(lacks, coordinate)
    )
    full = wanted.select("tree", chunk, "at", "doc_id", "source", "digest", "altered", "size")
    kind = full.schema["doc_id"].dataType.simpleString()
    result = (
        f"doc_id {kind}, source string, leaf string, subroot string, root string, proof_sha256 string,"
        " folded_root string, verified boolean"
    )
    fetched = _fetch(manifest, asked).groupBy("for_tree", "for_chunk")
    return full.groupBy("tree", "chunk").cogroup(fetched).applyInArrow(expand, result)


def _fetch(manifest: Manifest, asked: DataFrame) -> DataFrame:
    """``asked`` with the digests, each level's nodes joined with what is asked of that level.

    A node high up is asked for by very many partitions. Both sides therefore carry a part number: what is asked is
    dealt over as many parts as the level's busiest node needs, and the node is there once for each.
    """
    is_top = F.expr(f"tree = {TOP}").alias("is_top")
    asked_for = asked.groupBy(is_top, "level", "tree", "at").agg(F.count("*").alias("n"))
    busiest = asked_for.groupBy("is_top", "level").agg(F.max("n").alias("most")).orderBy("is_top", "level").collect()
    out = asked.where("FALSE").withColumn("digest", F.lit(None).cast("binary"))
    for row in busiest:
        nodes = (manifest.top if row.is_top else manifest.levels)[row.level]
        parts = -(-row.most // READERS)
        of_level = asked.where((F.col("level") == row.level) & (is_top == row.is_top))
        dealt = of_level.withColumn("part", F.pmod(F.xxhash64("for_tree", "for_chunk"), F.lit(parts)))
        copies = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
        there = nodes.select("tree", "at", "digest", copies)
        out = out.unionByName(dealt.join(there, ["tree", "at", "part"]).select(*out.columns))
    return out


#: Of a row to tamper with, the text that it then has; null for the others.
TAMPERED = (
    "CASE WHEN CRC32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0"
    " THEN TRANSLATE(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END"
)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` proved against the manifest, a fifth of them tampered with."""
    return prove(build(table(spark, sf_dir, "documents"), TAMPERED)).drop("source")


# The same in DuckDB's SQL. A digit's CRC is a fold over half bytes; each level of a tree is one aggregate.

#: CRC-32 of the sixteen half bytes, reflected polynomial 0xEDB88320.
_CRC = []
for _half in range(16):
    for _ in range(4):
        _half = (_half >> 1) ^ (0xEDB88320 if _half & 1 else 0)
    _CRC.append(_half)

#: Levels that the SQL spells out: 16 ** 5 leaves a tree.
SQL_LEVELS = 5


def _sql_leaf(text: str) -> str:
    fields = [text if name == "text" else f"cast({name} AS varchar)" for name in FIELDS]
    return "sha256(" + " || ".join(
        f"coalesce(cast(octet_length(encode({f})) AS varchar) || ':' || {f}, '-')" for f in fields
    ) + ")"


def _sql_tree(name: str, leaves: str) -> str:
    """CTEs ``name``_0 ... with (tree, pos, digest, size) of each level of the trees over ``leaves``."""
    text = f"{name}_0 AS MATERIALIZED (SELECT tree, pos, digest, size FROM {leaves})"
    for level in range(1, SQL_LEVELS + 1):
        text += f""",
{name}_{level} AS MATERIALIZED (
  SELECT tree, pos // {ARITY} AS pos, sha256(string_agg(digest, '' ORDER BY pos)) AS digest, size
  FROM {name}_{level - 1} WHERE size > {ARITY ** (level - 1)} GROUP BY tree, pos // {ARITY}, size)"""
    return text


def _sql_steps(name: str, rows: str) -> str:
    """CTEs that add each level's siblings to the proof of ``rows`` and fold them into its digest."""
    text, before = "", rows
    for level in range(SQL_LEVELS):
        text += f""",
{name}_run_{level} AS MATERIALIZED (
  SELECT tree, pos // {ARITY} AS run, list(digest ORDER BY pos) AS run_of FROM {name}_{level}
  WHERE size > {ARITY**level} GROUP BY tree, pos // {ARITY}),
{name}_step_{level} AS (
  SELECT r.* EXCLUDE (proof, folded, {name}_pos),
    CASE WHEN run_of IS NULL THEN proof ELSE proof || array_to_string(run_of[:{name}_pos % {ARITY}], '')
      || array_to_string(run_of[{name}_pos % {ARITY} + 2:], '') END AS proof,
    CASE WHEN run_of IS NULL THEN folded ELSE sha256(array_to_string(run_of[:{name}_pos % {ARITY}], '') || folded
      || array_to_string(run_of[{name}_pos % {ARITY} + 2:], '')) END AS folded,
    {name}_pos // {ARITY} AS {name}_pos
  FROM {before} r LEFT JOIN {name}_run_{level} n ON n.tree = r.{name}_tree AND n.run = r.{name}_pos // {ARITY})"""
        before = f"{name}_step_{level}"
    return text


def oracle() -> str:
    table_of = "[" + ", ".join(f"{n}::BIGINT" for n in _CRC) + "]"
    nibble = f"xor(c >> 4, ({table_of})[(xor(c, b) & 15) + 1])"
    halves = "flatten([[ascii(d) & 15, ascii(d) >> 4] for d in string_split(cast(doc_id AS varchar), '')])"
    crc = f"xor(list_reduce([4294967295::BIGINT] || {halves}::BIGINT[], lambda c, b: {nibble}), 4294967295)"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH leafed AS MATERIALIZED (
  SELECT doc_id, source, {_sql_leaf("text")} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND {crc} % 5 = 0 THEN {_sql_leaf(lowered)} END AS altered FROM documents),
placed AS MATERIALIZED (
  SELECT doc_id, leaf, altered, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY source) AS size FROM leafed),
{_sql_tree("s", "(SELECT tree, pos, leaf AS digest, size FROM placed)")},
subroots AS MATERIALIZED (
  SELECT -1 AS tree, tree AS pos, digest, count(*) OVER () AS size FROM (
    {" UNION ALL ".join(
        f"SELECT tree, digest FROM s_{level} WHERE size <= {ARITY**level}"
        + (f" AND size > {ARITY ** (level - 1)}" if level else "")
        for level in range(SQL_LEVELS + 1)
    )}) crowns),
{_sql_tree("t", "subroots")},
peak AS (SELECT digest AS root FROM (
    {" UNION ALL ".join(
        f"SELECT digest FROM t_{level} WHERE size <= {ARITY**level}"
        + (f" AND size > {ARITY ** (level - 1)}" if level else "")
        for level in range(SQL_LEVELS + 1)
    )}) peaks),
start AS (
  SELECT doc_id, leaf, tree AS s_tree, pos AS s_pos, tree AS t_pos, -1 AS t_tree, '' AS proof,
         coalesce(altered, leaf) AS folded FROM placed){_sql_steps("s", "start")}{_sql_steps("t", f"s_step_{SQL_LEVELS - 1}")}
SELECT f.doc_id, f.leaf, r.digest AS subroot, p.root, sha256(f.proof) AS proof_sha256, f.folded AS folded_root,
       f.folded = p.root AS verified
FROM t_step_{SQL_LEVELS - 1} f JOIN subroots r ON r.pos = f.s_tree CROSS JOIN peak p"""
