"""The pipeline against plain versions of its stages."""

from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from statement_lake.llm import mixture
from tests.llm.test_mixture import plain as plain_mixture
from tests.llm.test_near_duplicates import expected as plain_components

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    stages = dict(pipeline.STAGES)
    told = stages["language_id"](spark, documents, FOLDER)
    assert told.columns == documents.columns and told.schema == documents.schema
    assert told.count() == documents.where("text rlike '[A-Za-z]'").count()

    rows = [(r.doc_id, r.text) for r in told.collect()]
    kept = stages["simhash_near_duplicates"](spark, told, FOLDER)
    assert {r.doc_id for r in kept.collect()} == {i for i, _, c in plain_components(rows) if i == c}

    masked = stages["secret_scan"](spark, kept, FOLDER)
    assert masked.count() == kept.count()
    assert masked.where("text rlike 'AKIA[A-Z0-9]{14}' OR text rlike '[0-9a-f]{16}'").count() == 0
    clean = masked.join(kept, ["doc_id", "text"]).count()
    assert clean >= 0.7 * kept.count()

    mixed = stages["source_mixture"](spark, masked, FOLDER)
    table = [(r.doc_id, r.text, r.lang, r.source) for r in masked.collect()]
    wanted = plain_mixture(table, mixture.SHARE, 1, mixture.SEED)
    assert sorted(r.doc_id for r in mixed.collect()) == sorted(w[0] for w in wanted)

    packed = pipeline.run(spark, FOLDER)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {w[0] for w in wanted}


def test_null_rows_and_empty_tables(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(20)
    odd = documents.limit(2).select(*[F.lit(None).cast(t).alias(n) for n, t in documents.dtypes])
    for table in (documents.union(odd), documents.limit(0)):
        for _, stage in pipeline.STAGES[:-1]:
            found = stage(spark, table, FOLDER)
            assert found.columns == documents.columns
            found.count()
