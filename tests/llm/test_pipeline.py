"""The stages of the pipeline, one by one, and the queries against their SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.conftest import texts
from tests.llm.test_operators import brute_lines
from tests.test_oracle import rows
from tidemark.llm import op05_quality, op10_lines, queries, scratch

DATA = "/root/testdata/sf0.001"


def test_stages(spark, docs):
    columns, now = docs.columns, docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = scratch.keep(stage(spark, now, DATA), name)
        kept[name] = now
        assert now.columns == columns
    model = op05_quality.fit(docs, spark.read.parquet(f"{DATA}/labels.parquet"))
    want = {i for i, t in texts(docs) if model.score(op05_quality.features(t)[None])[0] >= 0.5}
    assert {i for i, _ in texts(kept["quality"])} == want
    pages = [(r["doc_id"], r["text"], r["source"]) for r in kept["quality"].collect()]
    assert sorted(texts(kept["lines"]), key=repr) == [(i, t) for i, t, _ in brute_lines(pages, op10_lines.RATIO, op10_lines.LEAST_PAGES)]
    assert all(r["n_chars"] == len(r["text"]) for r in kept["lines"].collect())
    before, after = texts(kept["lines"]), texts(kept["near_duplicates"])
    assert {" ".join(t.lower().split()) for _, t in before} >= {" ".join(t.lower().split()) for _, t in after}
    assert len({t for _, t in after}) == len(after) < len(before)
    packed = corpus_pipeline.run(spark, DATA)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {i for i, _ in after}


def test_stages_on_odd_rows(spark, odd, empty):
    for frame in (odd, empty):
        now = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = scratch.keep(stage(spark, now, DATA), "stage")
            assert now.columns == frame.columns
        tokenizer, want = Tokenizer.from_file(corpus_pipeline.WORD_VOCABULARY), []
        for i, t in texts(now):
            n = len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1
            want += [(i, k, start, min(2048, n - start)) for k, start in enumerate(range(0, n, 2048))]
        packed = corpus_pipeline.STAGES[-1][1](spark, now, DATA).collect()
        assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"]) for r in packed), key=repr) == sorted(want, key=repr)
    stayed = corpus_pipeline.near_duplicates(spark, odd, DATA)
    assert sorted(r["doc_id"] for r in stayed.filter(F.col("doc_id").isNotNull()).collect()) == [-5, 1, 4, 8, 9, 10, 11, 12, 13]
    assert stayed.filter("doc_id is null").count() == 2


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    got, want = queries.QUERIES[name](spark, DATA), duck.sql(queries.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())


def test_every_operator_has_its_query():
    assert [n for n in queries.QUERIES if n.startswith("op")] == [next(q for q in queries.QUERIES if q.startswith(f"op{k}_")) for k in range(1, 11)]
    assert "pipeline" in queries.QUERIES and len(corpus_pipeline.STAGES) == 4


def test_shared_folder_is_the_session_s(spark):
    assert scratch.place(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_rows_with_and_without_keys(spark):
    """Exact, whatever the bit map lets through; only a table of bounded size is broadcast."""
    frame = spark.createDataFrame([(k if k % 5 else None, f"t{k}", 1) for k in range(2000)], "id long, text string, tidemark_likely int")
    keys = scratch.keep(spark.range(0, 2000, 3).select(F.col("id").alias("k")), "keys")
    inside, outside = scratch.among(frame, F.col("id"), keys), scratch.without(frame, F.col("id"), keys)
    assert inside.columns == outside.columns == frame.columns
    assert sorted(r["id"] for r in inside.collect()) == [k for k in range(2000) if k % 5 and k % 3 == 0]
    assert sorted(r["text"] for r in outside.collect()) == sorted(f"t{k}" for k in range(2000) if not (k % 5 and k % 3 == 0))
    none = scratch.keep(keys.limit(0), "none")
    assert scratch.among(frame, F.col("id"), none).count() == 0 and scratch.without(frame, F.col("id"), none).count() == 2000


def test_a_full_bit_map_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(scratch, "MOST_BITS", 1 << 15)
    frame = spark.range(200_000)
    keys = scratch.keep(spark.range(0, 200_000, 2).select(F.col("id").alias("k")), "keys")
    assert scratch.likely(frame, F.col("id"), keys, "maybe").filter("maybe and id % 2 = 0").count() == 100_000
    assert scratch.without(frame, F.col("id"), keys).agg(F.sum("id")).first()[0] == sum(range(1, 200_000, 2))


def test_vocabularies_are_sent_to_the_executors(spark, tmp_path):
    """A task opens the copy that came with it, and the driver its own."""
    import pyarrow as pa

    mine = tmp_path / "sent.txt"
    mine.write_text("pieces")
    for _ in range(2):
        scratch.ship_file(spark, str(mine))

    def seen(batches):
        for _ in batches:
            with open(place := scratch.here(str(mine))) as file:
                yield pa.RecordBatch.from_arrays([pa.array([place]), pa.array([file.read()])], names=["place", "text"])

    (found,) = spark.range(1).coalesce(1).mapInArrow(seen, "place string, text string").collect()
    assert found["place"] != str(mine) == scratch.here(str(mine)) and found["text"] == "pieces"
