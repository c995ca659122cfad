"""HTML extraction: site templates found by counting hashed subtrees per host, and the article that is left.

Every page is parsed and each element's subtree hashed. Spark counts per host on how many different pages a
subtree occurs; those that recur on many are the site's template and go from the pages of that host. What a page
has of its own beside the article (adverts, forms, comments, ...) goes by element, role, class and id.

Pages count as different when their longest blocks differ, so a thousand copies of an article are one page and
their article is no template. Two thresholds keep passages that articles share: an element goes when it recurs on
``recurs`` pages, but inside a marked article, or as a lone piece of prose, only when it is also on a ``share`` of
the host's pages (``sure`` pages at least).
"""

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerlake.llm.markup import PLAIN, STRICT, Page
from tellerlake.llm.tables import flagged, flags, store, table

#: The host of an address, without user and port, in lower case.
_HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
#: A page's identity for joins: equal pages have equal text.
_KEY = ("xxhash64(url IS NULL, url, html) AS k1", "xxhash64(html, url IS NULL, url, 'again') AS k2")


def _host(url: str) -> str:
    return f"NULLIF(REGEXP_EXTRACT(LOWER({url}), '{_HOST}', 1), '')"


def subtrees(pages: DataFrame) -> DataFrame:
    """(k1, k2, host, page, beside, strict, plain) of the different pages: identity, and digests of the elements.

    Rows without html or without a host in their url have no site and are left out. Of the host a hash is kept.
    """

    def hashed(batches):
        for batch in batches:
            parsed = [Page(text.as_py()) for text in batch.column("html")]
            kinds = zip(*(page.subtrees() for page in parsed)) if parsed else ((), (), ())
            yield pa.record_batch(
                [
                    *(batch.column(name) for name in ("k1", "k2", "host")),
                    pa.array([page.identity() for page in parsed], pa.int64()),
                    *(pa.array([sorted(found) for found in kind], pa.list_(pa.int64())) for kind in kinds),
                ],
                names=["k1", "k2", "host", "page", "beside", "strict", "plain"],
            )

    known = pages.selectExpr(*_KEY, f"{_host('url')} AS host", "html").where("host IS NOT NULL AND html <> ''")
    digests = "beside array<long>, strict array<long>, plain array<long>"
    rows = known.withColumn("host", F.xxhash64("host"))
    return rows.mapInArrow(hashed, f"k1 long, k2 long, host long, page long, {digests}")


def templates(found: DataFrame, recurs: int, sure: int, share: float) -> DataFrame:
    """(host, subtree, kind) of what recurs on the different pages of a host.

    Rows are made distinct before they are counted, and both steps are aggregated before their shuffles and keyed
    by the subtree too, so a host with a third of all pages is spread over tasks like the others.
    """
    different = found.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("of"))
    every = F.explode(F.concat("beside", "strict", "plain")).alias("subtree")
    seen = found.select("host", "page", every).distinct()
    counted = seen.groupBy("host", "subtree").agg(F.count("*").alias("n")).where(F.col("n") >= recurs)
    strict = (F.col("n") >= sure) & (F.col("n") >= F.col("of") * share)
    kind = F.when(strict, STRICT).otherwise(PLAIN).alias("kind")
    return counted.join(different, "host").select("host", "subtree", kind)


def _marked(host: str, subtree: str):
    return F.xxhash64(host, subtree)


def listed(found: DataFrame, of_site: DataFrame) -> DataFrame:
    """(k1, k2, subtrees, kinds) of the pages that lose elements: what they lose, as two lists of one order.

    Few subtrees are templates that matter to their page. A table of leading bits of these, of fixed size, leaves
    out most others before the shuffle, whichever page they are of.
    """
    of_site = store(of_site.withColumn("mark", _marked("host", "subtree")))
    each = []
    for needed, column in ((PLAIN, "plain"), (STRICT, "strict")):
        enough = of_site.where(F.col("kind") >= needed)
        rows = found.select("k1", "k2", "host", F.explode(column).alias("subtree"))
        may = rows.withColumn("mark", _marked("host", "subtree")).where(flagged("mark", flags(enough, "mark")))
        each.append(may.join(enough.drop("mark"), ["host", "subtree"]).select("k1", "k2", "subtree", "kind"))
    gone = F.sort_array(F.collect_set(F.struct("subtree", "kind"))).alias("gone")
    pairs = each[0].union(each[1]).groupBy("k1", "k2").agg(gone)
    return pairs.select("k1", "k2", F.col("gone.subtree").alias("subtrees"), F.col("gone.kind").alias("kinds"))


def extract(pages: DataFrame, recurs: int = 5, sure: int = 10, share: float = 0.5) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html).

    Null or empty html, and pages without an article, give an empty text. Rows without a host in their url lose no
    templates. Repeated rows stay repeated with equal texts. Texts may be of any length; markup may be broken or
    nested to any depth. An empty table gives no rows; other columns are ignored, whatever their names.

    The html is parsed twice: to hash it, and to extract the text. Only pages that lose elements, and the few that a
    table of fixed size can't tell from them, are shuffled, to meet the list of what they lose; that join has no
    hint, and adaptive execution splits the partition of a page that is copied often.
    """
    pages = pages.select("page_id", "url", "html")
    found = store(subtrees(pages))
    lists = store(listed(found, templates(found, recurs, sure, share)))
    loses = flagged("k1", flags(lists, "k1"))
    keyed = pages.selectExpr("*", *_KEY).withColumn("loses", loses)
    whole = keyed.where("NOT loses").selectExpr("page_id", "url", "html", "NULL AS subtrees", "NULL AS kinds")
    joined = keyed.where("loses").join(lists, ["k1", "k2"], "left").select("page_id", "url", "html", "subtrees", "kinds")

    def cleaned(batches):
        for batch in batches:
            texts = []
            for row in zip(*(batch.column(name) for name in ("html", "subtrees", "kinds"))):
                text, gone, kinds = (value.as_py() for value in row)
                texts.append(Page(text).article(dict(zip(gone or (), kinds or ()))) if text else "")
            yield pa.record_batch(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                names=["page_id", "url", "text"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    out = whole.union(joined).mapInArrow(cleaned, f"page_id {kind}, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))


def op11_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article text of every row of ``pages``, with the production thresholds."""
    return extract(table(spark, sf_dir, "pages"))
