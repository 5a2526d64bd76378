"""Landing, typed tables, seeds, manifests: what is accepted, refused and pruned."""

import json

import fixtures as X
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas as S
from tidemark.operators import payloads as P
from tidemark.operators import recovery
from tidemark.plans import reference_data
from tidemark.sources import landing, layout, publish, seeds, typed


def test_payload_table_is_immutable(spark, tmp_path):
    path = str(tmp_path / "payloads")
    first = X.full_landing(spark)
    landing.append_payloads(first, path)
    stored = landing.read_payload_table(spark, path)
    S.require_schema(stored.select(*S.LANDING_SCHEMA.names), S.LANDING_SCHEMA)
    assert {r.payload for r in stored.collect()} == {r.payload for r in first.collect()}
    with pytest.raises(landing.RunExists):
        landing.append_payloads(first, path)
    with pytest.raises(landing.RunExists):
        landing.append_payloads(first.unionByName(first), str(tmp_path / "other"))


def test_payload_table_prunes_by_date(spark, tmp_path, capsys):
    path = str(tmp_path / "payloads")
    landing.append_payloads(X.full_landing(spark), path)
    landing.append_payloads(X.full_landing(spark, X.RUN_2), path)
    day = landing.read_payload_table(spark, path).where("source = 'fred' AND ingestion_date = DATE '2025-03-04'")
    assert day.count() == 2
    day.explain()
    assert "PartitionFilters: [isnotnull(source" in capsys.readouterr().out


def write_run(root, identity, day, run, **files):
    folder = root / identity[0] / identity[1] / f"ingestion_date={day}" / f"run_id={run}"
    folder.mkdir(parents=True)
    for name, body in files.items():
        (folder / name.replace("_", ".", 1)).write_text(body)
    return folder


def test_payload_files_round_trip(spark, tmp_path):
    run = "20250301T223000000125Z--entity-QUFQTA"
    body = json.dumps(X.prices(), indent=2) + "\n"
    write_run(tmp_path, S.PRICES, "2025-03-01", run, payload_json=body)
    frame = landing.read_payload_files(spark, str(tmp_path), *S.PRICES)
    row = frame.head()
    assert (row.run_id, row.entity, row.payload) == (run, "AAPL", body)
    verdicts = P.parse(frame, "market_daily_prices")
    assert P.accepted_rows(verdicts, S.CONTRACTS["market_daily_prices"]).count() == 2


def test_written_payload_files_read_back(spark, tmp_path):
    both = X.landing(spark, [(S.PRICES, e, X.RUN_1, X.prices(e)) for e in ("A", "B")] + [(S.SUBMISSIONS, "1", X.RUN_1, X.submissions())])
    landing.write_payload_files(both, str(tmp_path), *S.PRICES, existing=None)
    back = landing.read_payload_files(spark, str(tmp_path), *S.PRICES)
    assert {(r.entity, r.ingested_at, r.payload.rstrip()) for r in back.collect()} == {
        (r.entity, r.ingested_at, r.payload) for r in both.where("dataset = 'daily_market_prices'").collect()
    }
    with pytest.raises(landing.RunExists):
        landing.write_payload_files(both, str(tmp_path), *S.PRICES, existing=back)


def test_manifest_and_latest_pair(spark, tmp_path):
    first, second = "20250301T000000000000Z--entity-QQ", "20250302T000000000000Z"
    write_run(tmp_path, S.PRICES, "2025-03-01", first, payload_json="{}", data_parquet="x")
    write_run(tmp_path, S.PRICES, "2025-03-02", second, payload_json="{}", notes_txt="x")
    runs = layout.manifest(layout.list_artifacts(spark, str(tmp_path)))
    rows = {r.run_id: r for r in runs.collect()}
    assert (rows[first].raw_present, rows[first].typed_present, rows[first].stray_count, rows[first].entity) == (True, True, 0, "A")
    assert (rows[second].typed_present, rows[second].stray_count, rows[second].entity) == (False, 1, None)
    inventory = {r.dataset: r for r in layout.dataset_inventory(runs).collect()}
    assert len(inventory) == 5 and inventory["submissions"].latest_run_id is None
    latest = inventory["daily_market_prices"]
    assert (latest.latest_run_id, latest.latest_pair_present, latest.run_count) == (second, False, 2)


def test_recovery_states(spark):
    contract = S.CONTRACTS["market_daily_prices"]
    frame = X.landing(spark, [(S.PRICES, e, X.RUN_1, X.prices(e)) for e in ("A", "B", "C")] + [(S.PRICES, "D", X.RUN_1, "{")])
    runs = {r.entity: r.run_id for r in frame.collect()}
    rows = P.accepted_rows(P.parse(frame, contract.name), contract)
    stored = rows.where(F.col("run_id") != runs["B"]).withColumn(
        "volume", F.when(F.col("run_id") == runs["C"], 0).otherwise(F.col("volume"))
    )
    listed = [(*S.PRICES, runs["A"], True, True, 0), (*S.PRICES, runs["B"], True, False, 0), (*S.PRICES, runs["C"], True, True, 0),
              (*S.PRICES, runs["D"], True, False, 0), (*S.PRICES, "E", False, True, 0), (*S.PRICES, "F", False, False, 0), (*S.PRICES, "G", True, True, 2)]
    manifest = spark.createDataFrame(listed, "source string, dataset string, run_id string, raw_present boolean, typed_present boolean, stray_count int")
    outcomes = recovery.recover_or_verify(manifest, frame, stored, P.parse_prices, contract)
    names = {v: k for k, v in runs.items()}
    assert {names.get(r.run_id, r.run_id): r.outcome for r in outcomes.collect()} == {
        "A": "verified", "B": "rebuilt", "C": "error", "D": "error", "E": "error", "F": "none", "G": "error",
    }
    rebuilt = recovery.rebuilt_rows(outcomes, frame, P.parse_prices, contract)
    assert {r.symbol for r in rebuilt.collect()} == {"B"} and rebuilt.count() == 2


def test_typed_table_contract(spark, tmp_path):
    contract = S.CONTRACTS["market_daily_prices"]
    rows = P.accepted_rows(P.parse(X.full_landing(spark), contract.name), contract)
    path = str(tmp_path / "prices")
    typed.write_new(rows, path, contract.schema)
    assert typed.read_table(spark, path, contract.schema).count() == 2
    with pytest.raises(Exception, match="already exists"):
        typed.write_new(rows, path, contract.schema)
    with pytest.raises(S.SchemaMismatch):
        typed.append_rows(rows.withColumn("close", F.col("close").cast("double")), path, contract.schema)
    rows.drop("volume").write.parquet(str(tmp_path / "short"))
    with pytest.raises(S.SchemaMismatch, match="volume"):
        typed.read_table(spark, str(tmp_path / "short"), contract.schema)
    with pytest.raises(ValueError):
        typed.write_new(rows, path, T.StructType([]))


def test_source_tables_are_created_once(spark, tmp_path):
    paths = typed.create_source_tables(spark, str(tmp_path))
    assert sorted(paths) == sorted(["ingestion_runs", *S.CONTRACTS])
    typed.create_source_tables(spark, str(tmp_path))
    assert all(t.count() == 0 for t in typed.read_source_tables(spark, str(tmp_path)).values())


def test_seed_keeps_leading_zeros(spark, tmp_path):
    path = tmp_path / "seed.csv"
    lines = ["company_key,current_ticker,source_cik,registrant_role,is_current_registrant"]
    lines += [",".join(str(v).lower() if isinstance(v, bool) else v for v in row) for row in reference_data.COMPANY_IDENTITIES]
    path.write_text("\n".join(lines) + "\n")
    seed = seeds.read_seed(spark, str(path), S.IDENTITY_MAPPING_SCHEMA)
    assert sorted(tuple(r) for r in seed.collect()) == sorted(reference_data.COMPANY_IDENTITIES)
    stored = seeds.refresh_seed(seed, str(tmp_path / "stored"))
    seeds.refresh_seed(seed.limit(2), str(tmp_path / "stored"))
    assert spark.read.parquet(str(tmp_path / "stored")).count() == 2 and stored.schema.names == seed.schema.names


def test_json_output_writes_nulls_and_iso_dates(spark):
    df = spark.sql("SELECT 1 AS n, DATE '2024-01-02' AS d, TIMESTAMP '2024-01-02 03:04:05' AS t, CAST(NULL AS STRING) AS s")
    assert json.loads(publish.as_json(df).head().json) == {"n": 1, "d": "2024-01-02", "t": "2024-01-02T03:04:05Z", "s": None}


@pytest.mark.parametrize("name,ok", [("sec_edgar", True), ("a", True), ("_a", False), ("a_", False), ("A", False), ("a-b", False), ("", False)])
def test_layout_component(spark, name, ok):
    assert spark.range(1).select(layout.is_component(F.lit(name))).head()[0] is ok


def test_file_without_a_column_is_refused(spark, tmp_path):
    paths = typed.create_source_tables(spark, str(tmp_path))
    contract = S.CONTRACTS["market_daily_prices"]
    landed = X.landing(spark, [(S.PRICES, "AAPL", X.RUN_1, X.prices())])
    rows = P.accepted_rows(P.parse(landed, contract.name), contract)
    typed.append_rows(rows, paths[contract.name], contract.schema)
    typed.require_whole_files(spark, str(tmp_path))
    rows.drop("volume").write.mode("append").parquet(paths[contract.name])
    with pytest.raises(S.SchemaMismatch, match="has no column volume"):
        typed.require_whole_files(spark, str(tmp_path))


def test_reading_refuses_a_single_short_file(spark, tmp_path):
    paths = typed.create_source_tables(spark, str(tmp_path))
    contract = S.CONTRACTS["market_daily_prices"]
    landed = X.landing(spark, [(S.PRICES, "AAPL", X.RUN_1, X.prices())])
    rows = P.accepted_rows(P.parse(landed, contract.name), contract)
    typed.append_rows(rows, paths[contract.name], contract.schema)
    assert typed.read_table(spark, paths[contract.name], contract.schema).count() == rows.count()
    day = next(p for p in (tmp_path / contract.name).iterdir() if p.name.startswith("ingestion_date=2"))
    rows.drop("volume").coalesce(1).write.parquet(str(tmp_path / "short"))
    short = next((tmp_path / "short").glob("*.parquet"))
    (day / "part-late.parquet").write_bytes(short.read_bytes())
    for _ in range(2):
        with pytest.raises(S.SchemaMismatch, match="part-late.parquet has no column volume"):
            typed.read_table(spark, paths[contract.name], contract.schema)


def test_every_file_is_checked_once(spark, tmp_path):
    path, contract = str(tmp_path / "t"), T.StructType([T.StructField("k", T.LongType()), T.StructField("flag", T.BooleanType())])
    spark.range(4).selectExpr("id AS k", "true AS flag").repartition(2).write.parquet(path)
    assert typed.check_new_files(spark, path, contract) == 2
    assert typed.check_new_files(spark, path, contract) == 0
    spark.range(4).selectExpr("id AS k", "CAST(NULL AS BOOLEAN) AS flag").coalesce(1).write.mode("append").parquet(path)
    spark.range(4).selectExpr("id AS k", "id > 1 AS flag").coalesce(1).write.mode("append").parquet(path)
    assert typed.check_new_files(spark, path, contract) == 2
    assert typed.read_table(spark, path, contract).count() == 12


@pytest.mark.parametrize("flags", ["true", "false", "id > 1", "CAST(NULL AS BOOLEAN)"])
def test_file_without_a_boolean_is_refused(spark, tmp_path, flags):
    path, contract = str(tmp_path / "t"), T.StructType([T.StructField("k", T.LongType()), T.StructField("flag", T.BooleanType())])
    spark.range(4).selectExpr("id AS k", f"{flags} AS flag").write.parquet(path)
    spark.range(2).selectExpr("id AS k").coalesce(1).write.mode("append").parquet(path)
    with pytest.raises(S.SchemaMismatch, match="has no column flag"):
        typed.read_table(spark, path, contract)


def test_other_types_and_columns_are_refused(spark, tmp_path):
    contract = T.StructType([T.StructField("k", T.LongType()), T.StructField("flag", T.BooleanType())])
    for n, columns in enumerate((["id AS k", "'x' AS flag"], ["id AS k", "true AS flag", "1 AS more"], ["CAST(id AS INT) AS k", "true AS flag"])):
        path = str(tmp_path / str(n))
        spark.range(2).selectExpr(*columns).write.parquet(path)
        with pytest.raises(S.SchemaMismatch):
            typed.read_table(spark, path, contract)
    mixed = str(tmp_path / "mixed")
    spark.range(2).selectExpr("id AS k", "true AS flag").write.parquet(mixed)
    assert typed.read_table(spark, mixed, contract).count() == 2
    spark.range(2).selectExpr("id AS k", "true AS flag", "1 AS more").write.mode("append").parquet(mixed)
    with pytest.raises(S.SchemaMismatch, match="more"):
        typed.read_table(spark, mixed, contract)
    apart = str(tmp_path / "apart")
    spark.range(2).selectExpr("id AS k", "true AS flag").write.parquet(apart)
    spark.range(2).selectExpr("'x' AS k", "true AS flag").write.mode("append").parquet(apart)
    with pytest.raises(S.SchemaMismatch):
        typed.read_table(spark, apart, contract)
