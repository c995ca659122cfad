import corpus_pipeline
from tellerlake.llm import catalog, mixing
from tellerlake.llm.tables import store, table

from .test_lines import plain
from .test_simhash import plain_groups


def test_each_stage_against_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns, texts = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    items = [r.text for r in table(spark, sf_dir, "benchmark").collect()]
    stages = dict(corpus_pipeline.STAGES)
    for name, stage in stages.items():
        docs = store(stage(spark, docs, sf_dir))
        now = {r.doc_id: r.text for r in docs.collect()}
        assert len(now) == docs.count()
        if name == "language_id":
            want = {i: t for i, t in texts.items() if t and any(c.isalpha() for c in t)}
        elif name == "line_dedup":
            want = plain(list(texts.items()))
            assert docs.where("n_chars != length(text)").count() == 0
        elif name == "simhash_near_dedup":
            keep = set(plain_groups(list(texts.items()))[1].values())
            want = {i: t for i, t in texts.items() if i in keep}
        elif name == "decontamination":
            gone = {i for i, t in texts.items() if any(q in t for q in items)}
            assert not gone & set(now) and len(texts) - len(now) <= len(gone) + 1 + len(gone) // 10
            want = {i: texts[i] for i in now}
        else:
            want = texts
        assert now == want, name
        if name != "source_mixing":
            assert docs.columns == columns
        texts = now
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(texts)
    assert [(r.slot, r.place) for r in rows] == sorted((r.slot, r.place) for r in rows)
    assert sum(mixing.SHARES.values()) == 1000


def test_queries_cover_the_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in catalog.QUERIES) == list(range(1, 14))


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, __language string, _first int, __key int"


def test_first_stage_on_odd_tables(spark):
    """Nulls, repeated rows, clashing names, no languages to learn from, and no rows."""
    rows = [(i, f"the cat and the dog {i}", None, "s", 3, "x", 1, 2) for i in range(20)]
    rows += [(1, "the cat", None, None, None, None, None, None)] * 2 + [(None, "a", "en", "s", 1, "x", 1, 2)]
    rows += [(30, None, "en", "s", 1, "x", 1, 2), (31, "", None, "s", 1, "x", 1, 2), (32, "12 !", "fr", "s", 1, "x", 1, 2)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = corpus_pipeline.language_id(spark, docs, "")
    assert kept.columns == docs.columns and sorted(map(str, kept.collect())) == sorted(map(str, rows_of(rows[:23], docs)))
    assert corpus_pipeline.language_id(spark, docs.limit(0), "").collect() == []


def rows_of(rows, docs):
    return docs.sparkSession.createDataFrame(rows, docs.schema).collect()


def test_first_stage_fills_in_languages(spark):
    words = {"en": "the house and the garden with a tree", "de": "das haus und der garten mit einem baum"}
    rows = [(i, f"{words[lang]} {i}", lang if i % 3 else None, "s", 1, "x", 1, 2) for i in range(60) for lang in words]
    kept = corpus_pipeline.language_id(spark, spark.createDataFrame(rows, SCHEMA), "")
    assert {(r.text, r.lang) for r in kept.collect()} == {(f"{words[lang]} {i}", lang) for i in range(60) for lang in words}


def test_rows_without_id_teach_nothing(spark):
    from tellerlake.llm.language import learned

    docs = spark.createDataFrame([(None, "only these speak so", "xx"), (1, "other words here", "en")], "doc_id long, text string, lang string")
    assert "xx" not in learned(docs).languages
