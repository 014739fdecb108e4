import random

import pytest

import corpus_pipeline
from rows import DOCS, frame, odd, words

import __spark_entry__ as entry
from platewright.llm import queries


def corpus(spark, tmp_path):
    """Clean documents, and what each stage is there for."""
    rng = random.Random(1)

    def text(n=120):
        return "\n".join(" ".join(words(rng, 12, 10**5)) + "." for _ in range(n // 12))

    items = [" ".join(words(rng, 25, 10**5)) for _ in range(3)]
    clean = [text() for _ in range(60)]
    bad = [" ".join(w + "###" for w in words(rng, 150)) for _ in range(5)] + ["few words", None, "again and again " * 80]
    copies = [clean[3], clean[4]]
    near = [" ".join(clean[5].split()), " ".join(clean[6].lower().split())]
    leaks = [text() + "\n" + items[0], items[1].upper() + "\n" + text()]
    header = "a header line that all of these documents have"
    lines = [header + "\n" + text() for _ in range(4)]
    texts = [*clean, *bad, *copies, *near, *leaks, *lines]
    sizes = {n: len(x) for n, x in (("clean", clean), ("bad", bad), ("copies", copies), ("near", near), ("leaks", leaks))}
    frame(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id int, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return texts, sizes, header


def test_what_stays(spark, tmp_path):
    texts, sizes, header = corpus(spark, tmp_path)
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    first_gone = sizes["clean"]
    gone = sum(sizes.values())
    assert {r["doc_id"] for r in rows} == set(range(first_gone)) | set(range(gone, len(texts)))
    whole = {r["doc_id"]: r for r in queries.bpe_digests(frame(spark, texts), queries.tokenizer_json()).collect()}
    without = [t.removeprefix(header + "\n") if i > gone else t for i, t in enumerate(texts) if i < first_gone or i >= gone]
    ids = [i for i in range(len(texts)) if i < first_gone or i >= gone]
    cut = {r["doc_id"]: r for r in queries.bpe_digests(frame(spark, without, ids), queries.tokenizer_json()).collect()}
    assert {r["doc_id"]: tuple(r) for r in rows} == {i: tuple(r) for i, r in cut.items()}
    assert whole[0] == cut[0] and whole[gone + 1] != cut[gone + 1]


def test_stages_keep_the_columns(spark, tmp_path):
    corpus(spark, tmp_path)
    for docs in (odd(spark), odd(spark).limit(0), spark.createDataFrame([], DOCS)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            found = stage(spark, docs, str(tmp_path))
            assert found.columns == docs.columns, name
            found.collect()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()


def test_every_operator_is_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and len(corpus_pipeline.STAGES) == 5


def test_queries_run_on_tables(spark, sf_dir):
    for name in ("op1_substring_dedup", "op2_line_dedup", "op6_sharding", "op8_warc"):
        rows = entry.queries()[name](spark, sf_dir)
        assert rows.count() > 0, name


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, sf_dir, name):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for table in ("documents", "pages"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    expected = connection.execute(queries.ORACLE[name])
    columns = [c[0] for c in expected.description]
    rows = entry.queries()[name](spark, sf_dir).select(*columns).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(expected.fetchall(), key=str)
