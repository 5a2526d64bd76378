from pyspark.sql import functions as F

from tidemark.llm.language_fusion import PRODUCTION, FusionRules, declared_language, fitted, identified, visible_text

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    train, test = docs.where("doc_id % 4 <> 0"), docs.where("doc_id % 4 = 0")
    model = fitted(train, FusionRules(sample_per_language=60), "text", "lang")
    records = test.select("doc_id", "text", F.lit(None).cast("string").alias("declared"), F.lit(None).cast("string").alias("host"))
    got = identified(records, model, keys=("doc_id",)).join(test.select("doc_id", "lang"), "doc_id")
    right = got.agg(F.avg((F.col("language") == F.col("lang")).cast("double"))).first()[0]
    assert right >= 0.97


def records(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, declared string, host string")


def test_evidence_adds_up(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = fitted(docs, PRODUCTION, "text", "lang")
    french, german = (docs.where(f"lang = '{x}'").first().text for x in ("fr", "de"))
    rows = [(k, french, None, "fr.example.org") for k in range(50)]
    rows += [(k, german, None, "de.example.org") for k in range(50, 100)] + [
        (100, "", "de", None), (101, None, None, "shop.example.de"), (102, "", None, "fr.example.org"),
        (103, french, "en", None), (104, None, None, None), (104, None, None, None), (None, "", "xx", ""),
    ]
    got = {}
    for r in identified(records(spark, rows), model, keys=("doc_id",)).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert got[100][0].language == "de"
    assert got[101][0].language == "de"
    assert got[102][0].language == "fr"
    assert got[103][0].language == "fr"
    assert len(got[104]) == 2 and got[104][0].language == got[104][1].language is not None
    assert all(0 < r.confidence <= 1 for rs in got.values() for r in rs)


def test_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = fitted(docs, FusionRules(sample_per_language=5), "text", "lang")
    assert identified(records(spark, []), model, keys=("doc_id",)).count() == 0
    none = fitted(docs.where("false"), PRODUCTION, "text", "lang")
    assert [r.language for r in identified(records(spark, [(1, "a", None, None)]), none, keys=("doc_id",)).collect()] == [None]


def test_page_parts(spark):
    page = '<HTML class=x lang="FR-be"><head><title>t</title></head><body><script>var x="</p>"</script><!-- no --><p>Oui&nbsp;là</p></body>'
    frame = spark.createDataFrame([(page,), (None,)], "html string")
    first = frame.select(declared_language(F.col("html")).alias("d"), F.trim(visible_text(F.col("html"))).alias("t")).first()
    assert first.d == "fr" and first.t.split() == ["Oui", "là"]
