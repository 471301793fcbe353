"""run() against plain Python over the smallest tables, stage by stage, and the registered queries against their SQL."""

import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import test_decontaminate as leaks  # noqa: E402
import test_mixing_sharding as mixes  # noqa: E402
import test_near_dup as near  # noqa: E402

import corpus_pipeline  # noqa: E402
from tidemark.llm import queries  # noqa: E402
from tidemark.llm.mixing import mix  # noqa: E402


def test_pipeline(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    whole = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
    predicted = {r.doc_id: r.predicted for r in queries.op6_toxicity(spark, data).collect()}
    clean = [r for r in whole if not predicted[r[0]]]
    kept = {i for i, (_, c) in near.brute(clean).items() if i == c}
    single = [r for r in clean if r[0] in kept]
    items = [tuple(r) for r in spark.read.parquet(f"{data}/benchmark.parquet").select("item_id", "text").collect()]
    hit = {i for i, _, n, _ in leaks.brute(single, items) if n}
    left = [r for r in single if r[0] not in hit]
    frame = spark.createDataFrame(left, "doc_id long, text string, lang string, source string")
    want = Counter({r.doc_id: r.copies for r in mix(frame).collect() if r.copies})
    sizes = Counter()
    for r in left:
        sizes[r[3]] += len(mixes.WORD.findall(r[1] or ""))
    goal = mixes.targets(sizes)
    assert sum(want[r[0]] * len(mixes.WORD.findall(r[1] or "")) for r in left) == pytest.approx(sum(goal.values()), rel=0.1)
    got = corpus_pipeline.run(spark, data).collect()
    assert Counter(r.doc_id for r in got) == want
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]


def test_stages_on_odd_rows(spark, docs, rows, none, tmp_path):
    """Nulls, repeated ids and rows, extra columns with the operators' own names, a very long text, and empty tables."""
    spark.createDataFrame([(r[0], 1, int(k % 9 == 0)) for k, r in enumerate(rows)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "one two"), (2, None), (None, "three")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    more = docs.where("doc_id = -6").withColumn("text", F.lit("quite another text under the same id, which stays in its own right")).unionByName(docs.where("doc_id is null"))
    for frame in (docs.unionByName(more), none):
        for name, stage in corpus_pipeline.STAGES:
            made = stage(spark, frame, str(tmp_path))
            path = f"{tmp_path}/{name}-{frame is none or not frame.head(1)}-{len(made.columns)}"
            made.write.mode("overwrite").parquet(path)
            before, frame = frame, spark.read.schema(made.schema).parquet(path)
            assert name == "sharding" or frame.columns == docs.columns
            if name == "decontamination":
                assert frame.where("lower(text) rlike '(^|[^a-z0-9])one[^a-z0-9]+two([^a-z0-9]|$)'").count() == 0
        counts = [r["count"] for r in frame.groupBy("shard").count().collect()]
        assert not counts or max(counts) - min(counts) <= 1


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, data, name):
    db = duckdb.connect()
    for t in ("documents", "conversations", "benchmark"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, data), db.execute(queries.ORACLE[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(str, map(tuple, got.select(*columns).collect()))) == sorted(map(str, want.fetchall()))  # a null stays one


def test_nothing_else_imports_llm():
    root = Path(__file__).resolve().parents[2] / "tidemark"
    assert not [f for f in root.rglob("*.py") if "llm" not in f.parts and "tidemark.llm" in f.read_text()]
