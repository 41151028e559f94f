from __future__ import annotations

import hashlib
import json
import os
import random
import subprocess
import sys
import time
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark import cloudpickle

from tests.conftest import trip
from waybill.operators import gate
from waybill.plans import kpis
from waybill.plans.monthly import _together, run_month
from waybill.plans.report import month_report
from waybill.profile import POLICY, Profile
from waybill.sources import manifest, publish, readers, sinks
from waybill.sources.sinks import staged

LABEL = "2026_01"


def test_zone_csv(spark, tmp_path, january):
    path = tmp_path / "zones.csv"
    rows = [f'{i},"Queens","Zone, {i}","Boro Zone"' for i in range(1, 264)]
    rows += ['264,"Unknown","N/A","N/A"', '265,"N/A","Outside","N/A"']
    path.write_text('"LocationID","Borough","Zone","service_zone"\n' + "\n".join(rows) + "\n")
    zones = readers.read_zones(spark, str(path))
    assert dict(zones.dtypes)["LocationID"] == "int" and zones.count() == 265
    last = zones.filter("LocationID = 265").first()
    assert (last["Borough"], zones.first()["Zone"]) == ("N/A", "Zone, 1")
    readers.require_complete_zones(zones, january)
    with pytest.raises(readers.IncompleteSource, match="100 rows"):
        readers.require_complete_zones(zones.limit(100), january)
    with pytest.raises(readers.IncompleteSource, match="Borough"):
        readers.require_complete_zones(zones.drop("Borough"), january)
    bad = readers.zone_completeness(zones.drop("Zone", "Borough"), january).first()
    assert (bad["missing_columns"], bad["status"]) == ("Borough, Zone", "INCOMPLETE")


def test_trip_files_conform(spark, make_trips, tmp_path):
    path = str(tmp_path / "trips")
    narrow = make_trips(trip()).selectExpr(
        "*", "CAST(VendorID AS INT) AS v", "CAST(passenger_count AS DOUBLE) AS p"
    )
    narrow.drop("VendorID", "passenger_count").withColumnsRenamed(
        {"v": "VendorID", "p": "passenger_count"}
    ).coalesce(1).write.parquet(path)
    trips = manifest.verified_trips(spark, path)
    assert trips.columns == list(readers.TRIP_COLUMNS)
    assert dict(trips.dtypes)["passenger_count"] == "bigint"
    with pytest.raises(readers.IncompleteSource, match="tip_amount"):
        readers.conform_trips(trips.drop("tip_amount"))


def test_mixed_trip_folder(spark, make_trips, tmp_path):
    path = str(tmp_path / "trips")

    def add(frame):
        frame.coalesce(1).write.mode("append").parquet(path)

    one = make_trips(trip())
    add(one)
    add(one.withColumn("VendorID", one["VendorID"].cast("int")).drop("cbd_congestion_fee"))
    add(one.withColumnRenamed("Airport_fee", "airport_fee"))
    add(one.selectExpr("* EXCEPT (passenger_count)", "double('nan') AS passenger_count"))
    add(one.selectExpr("* EXCEPT (passenger_count)", "2D AS passenger_count"))
    read = manifest.verified_trips(spark, path)
    assert dict(read.dtypes) == readers.TRIP_COLUMNS
    counts = sorted((r["passenger_count"] or 0) for r in read.collect())
    assert counts == [0, 1, 1, 1, 2]
    assert read.filter("cbd_congestion_fee IS NULL").count() == 1
    assert read.filter("Airport_fee = 0 AND VendorID = 1").count() == 5
    add(one.drop("tip_amount"))
    with pytest.raises(readers.IncompleteSource, match="parquet: trip columns missing: tip_amount"):
        manifest.verified_trips(spark, path)


def test_folders_of_several_kinds(spark, make_trips, tmp_path, monkeypatch):
    """Folders are scanned by name, files only where a folder mixes kinds; names hold anything."""
    path = tmp_path / "trips"
    plain = make_trips(trip(), trip(PULocationID=61))
    double = plain.selectExpr("* EXCEPT (passenger_count)", "3D AS passenger_count")
    for name, frames in {
        "a [1]/{b}": [plain, plain], "c d": [double], "mixed*": [plain, double], "e%20": [plain],
    }.items():
        for frame in frames:
            frame.coalesce(1).write.mode("append").parquet(str(path / name))
    listed = staged(manifest.file_manifest(spark, str(path)), str(tmp_path), "listed")
    monkeypatch.setattr(manifest, "file_manifest", None)
    read = manifest.verified_trips(spark, str(path), listed)
    assert sorted(r["passenger_count"] for r in read.collect()) == [1] * 8 + [3] * 4
    one = str(path / "c d")
    read = manifest.verified_trips(spark, one, listed.filter(listed["file_path"].contains("c d")))
    assert read.filter("passenger_count = 3").count() == 2


def test_verifying_leaves_nothing_and_gathers_no_paths(spark, make_trips, tmp_path, monkeypatch):
    path, scratch = str(tmp_path / "trips"), str(tmp_path / "scratch")
    make_trips(trip()).coalesce(1).write.parquet(path)
    monkeypatch.setattr(manifest, "scratch_folder", lambda spark: scratch)
    plans = []
    monkeypatch.setattr(manifest, "staged", lambda df, *args: (plans.append(df), staged(df, *args))[1])
    assert manifest.verified_trips(spark, path).count() == 1
    assert not os.path.exists(scratch) and len(plans) == 1
    assert "collect_list" not in open(manifest.__file__).read()


def test_hashes_hold(spark, tmp_path):
    pq.write_table(pa.table({"a": [1, 2]}), tmp_path / "t.parquet")
    assert [tuple(r) for r in manifest.hash_checks(spark, str(tmp_path)).collect()] == [("t.parquet", 2, True, True)]
    (tmp_path / "u.parquet").write_bytes(b"no table at all")
    with pytest.raises(Exception, match="u.parquet is not a Parquet file"):
        manifest.file_manifest(spark, str(tmp_path)).collect()


def test_a_failure_cancels_the_other_actions(spark):
    begun = time.monotonic()

    def fail():
        time.sleep(3)
        raise KeyError("failed")

    slow = spark.range(0, 10**13, numPartitions=8).selectExpr("max(hash(id))")
    with pytest.raises(KeyError, match="failed"):
        _together(spark, slow.collect, fail)
    assert time.monotonic() - begun < 60


def test_manifest(spark, tmp_path):
    table = pa.table({"a": list(range(5000)), "b": [str(i) for i in range(5000)]})
    pq.write_table(table, tmp_path / "one.parquet", row_group_size=1000)
    pq.write_table(table.slice(0, 0), tmp_path / "none.parquet")
    (tmp_path / "note.txt").write_text("not a table")
    listed = manifest.file_manifest(spark, str(tmp_path))
    rows = {r["file_name"]: r for r in listed.collect()}
    assert set(rows) == {"one.parquet", "none.parquet"}
    one, data = rows["one.parquet"], (tmp_path / "one.parquet").read_bytes()
    assert one["sha256"] == hashlib.sha256(data).hexdigest() and len(one["sha256"]) == 64
    assert (one["file_size_bytes"], one["num_rows"], one["num_row_groups"]) == (len(data), 5000, 5)
    assert (one["schema_columns"], one["num_columns"]) == (["a", "b"], 2)
    assert (one["status"], rows["none.parquet"]["status"]) == ("VERIFIED_COMPLETE", "EMPTY")
    footers = manifest.file_manifest(spark, str(tmp_path), hashed=False).drop("sha256")
    assert sorted(footers.collect()) == sorted(listed.drop("sha256").collect())
    with pytest.raises(readers.IncompleteSource, match="holds no rows"):
        manifest.verified_trips(spark, str(tmp_path / "none.parquet"))


@pytest.fixture
def small_ranges(spark, monkeypatch):
    """Files count as large, ranges, turns and parts as full, at sizes that a test can write."""
    monkeypatch.setattr(manifest, "WHOLE_BYTES", 9_000)
    monkeypatch.setattr(manifest, "TURN_BYTES", 20_000)
    monkeypatch.setattr(manifest, "PART_BYTES", 700)
    conf = {"spark.sql.files.maxPartitionBytes": "6000", "spark.sql.files.openCostInBytes": "1"}
    before = {key: spark.conf.get(key) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def large_files(path):
    """Parquet files of unlike sizes, with newlines anywhere and with none over several ranges."""
    mixed = random.Random(5)
    for i, (name, rows) in enumerate({"a [1]/{b}": 9_000, "e%20": 4_000, "c d": 2_500, "small": 10}.items()):
        (path / name).mkdir(parents=True)
        table = pa.table({
            "a": [mixed.choice((10, 13, 0x0A0A0A0A, mixed.getrandbits(60))) for _ in range(rows)],
            "none": [b"\0\r" * 2 if i % 2 else b"\n"] * rows,
        })
        pq.write_table(
            table, path / name / "t.parquet", compression="none", use_dictionary=False, row_group_size=1 + rows // (1 + 40 * (i == 1))
        )
    return sorted(path.rglob("*.parquet"))


def test_large_files_are_read_by_ranges(spark, tmp_path, small_ranges):
    paths = large_files(tmp_path / "in")
    listed = manifest.file_manifest(spark, str(tmp_path / "in"), scratch=str(tmp_path / "scratch"))
    rows = {r["file_path"].removeprefix("file:"): r for r in listed.collect()}
    assert sorted(rows) == list(map(str, paths))
    for path in paths:
        data, footer, row = path.read_bytes(), pq.ParquetFile(path), rows[str(path)]
        assert (row["sha256"], row["file_size_bytes"]) == (hashlib.sha256(data).hexdigest(), len(data))
        assert (row["num_rows"], row["num_row_groups"]) == (footer.metadata.num_rows, footer.metadata.num_row_groups)
        assert row["schema_columns"] == ["a", "none"]
    assert sum(len(p.read_bytes()) > manifest.WHOLE_BYTES for p in paths) == 3
    assert os.listdir(tmp_path / "scratch") == ["large"]
    footers = manifest.file_manifest(spark, str(tmp_path / "in"), hashed=False).drop("sha256")
    assert sorted(footers.collect()) == sorted(listed.drop("sha256").collect())
    checks = manifest.hash_checks(spark, str(tmp_path / "in")).collect()
    assert len(checks) == 4 and all(r["size_holds"] and r["hash_holds"] for r in checks)


def test_no_task_reads_a_large_file_whole(spark, tmp_path, small_ranges, monkeypatch):
    """Neither of the file nor of the ranges kept does a task read more than a turn and a range."""
    (tmp_path / "in").mkdir()
    drawn = random.Random(3)
    table = pa.table({"a": [drawn.getrandbits(62) for _ in range(20_000)]})
    pq.write_table(table, tmp_path / "in" / "t.parquet", compression="none", use_dictionary=False)
    read = []

    def counted(task):
        def count(batches):
            import pyarrow as pa

            size = 0
            for batch in batches:
                size += sum(len(x or b"") for x in batch.column(batch.num_columns - 1).to_pylist())
                yield from ()
            yield pa.record_batch([pa.array([size], pa.int64())], ["size"])

        return count

    # The bytes that reach the two kinds of task, measured in place of the tasks' own work.
    arrow = type(spark.range(1)).mapInArrow

    def watched(df, task, schema):
        read.append(max(r["size"] for r in arrow(df, counted(task), "size bigint").collect()))
        return arrow(df, task, schema)

    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", watched)
    manifest.file_manifest(spark, str(tmp_path / "in"), scratch=str(tmp_path / "scratch"))
    assert (tmp_path / "in" / "t.parquet").stat().st_size > 150_000
    assert len(read) > 8 and max(read) < 30_000


def test_large_files_that_are_no_tables(spark, tmp_path, small_ranges):
    for data in (b"\n" * 10_000, b"x" * 10_000, b"\xef\xbb\xbf" + b"ab\n" * 4_000):
        (tmp_path / "t.parquet").write_bytes(data)
        with pytest.raises(Exception, match="not a Parquet file|bytes has"):
            manifest.file_manifest(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("native", [True, False])
def test_a_hash_goes_on_from_its_state(native):
    """Any cut of any bytes gives the digest of the whole, also beside other files."""
    drawn = random.Random(7)
    for length in (0, 1, 55, 56, 63, 64, 65, 119, 128, 1_000, 4_096):
        datas = [drawn.randbytes(length), drawn.randbytes(length // 2)]
        states, places = [b"", b""], [0, 0]
        cuts = sorted(drawn.randrange(length + 1) for _ in range(3)) + [length + 1]
        for cut in cuts:
            last = cut > length
            rows = []
            for file, data in enumerate(datas):
                rows.append((file, len(data), places[file], states[file]))
                # The reader ends each last line, whether the file does or not.
                more = (data + b"\n" * (file == 0))[places[file] : cut]
                rows += [(file, None, None, more[i : i + 50]) for i in range(0, len(more), 50)]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int64(), pa.binary()))]
            batch = pa.record_batch(columns, ["file", "length", "done", "bytes"])
            batches = [batch.slice(i, 7) for i in range(0, len(rows), 7)]
            out = [r for b in manifest._hasher(last, native)(iter(batches)) for r in b.to_pylist()]
            states, places = [r["bytes"] for r in out], [r["done"] for r in out]
            assert last or [r["sha256"] for r in out] == [None, None]
        assert [r["sha256"] for r in out] == [hashlib.sha256(d).hexdigest() for d in datas]


def test_range_tasks_need_no_package(tmp_path):
    """As below, for the tasks that large files' ranges and hashes pass through."""
    (tmp_path / "tasks").write_bytes(cloudpickle.dumps((manifest._joiner(4), manifest._hasher(True))))
    code = (
        "import pickle, pyarrow as pa; join, hashed = pickle.load(open('tasks', 'rb'));"
        " lines = pa.record_batch({'file': pa.array([0, 0], pa.int32()), 'start': [0, 0], 'line': [b'abcd', b'e']});"
        " parts = pa.Table.from_batches(join(iter([lines]))); print(parts['bytes'].to_pylist());"
        " rows = pa.record_batch({'file': [0, 0], 'length': [3, None], 'done': [0, None], 'bytes': [b'', b'abc']});"
        " print(next(hashed(iter([rows])))['sha256'][0])"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert run.stdout.split("\n")[:2] == [str([b"abcd", b"\ne\n"]), hashlib.sha256(b"abc").hexdigest()], run.stderr


def test_manifest_task_needs_no_package(tmp_path):
    """Executors may run the hashing function without this package on their path."""
    pq.write_table(pa.table({"a": [1, 2]}), tmp_path / "t.parquet")
    task = cloudpickle.dumps(manifest._describer(manifest._COLUMNS))
    (tmp_path / "task").write_bytes(task)
    code = (
        "import pickle, pandas as pd; task = pickle.load(open('task', 'rb'));"
        " data = open('t.parquet', 'rb').read(); end = int.from_bytes(data[-8:-4], 'little') + 8;"
        " frame = pd.DataFrame({'path': ['file:/t.parquet'], 'length': [1], 'sha256': [None],"
        " 'footer': [data[-end:]]});"
        " print(next(task(iter([frame])))['num_rows'][0])"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    ran = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True)
    assert ran.stdout.strip() == b"2", ran.stderr


def test_missing_outputs(spark, tmp_path):
    out = str(tmp_path)
    assert readers.latest_month(spark, out, "2026-01").first()["month"] == "2026-01"
    with pytest.raises(readers.MissingOutput):
        readers.read_kpi(spark, out, readers.EXECUTIVE, LABEL)
    with pytest.raises(readers.MissingOutput):
        readers.read_audit(spark, out, LABEL)


def test_latest_month_goes_by_the_ledger(spark, tmp_path):
    out = str(tmp_path)

    def finished(label, run, when):
        publish.append(spark.sql(
            f"SELECT '{label}' AS label, '{run}' AS run, TIMESTAMP '{when}' AS finished,"
            f" 'x/{readers.EXECUTIVE}_{label}.csv' AS summary"), out)

    finished("2026_02", "b", "2026-04-01 10:00:00")
    finished("2026_01", "a", "2026-04-01 09:00:00")
    assert readers.latest_month(spark, out, "1970-01").first()["month"] == "2026-02"
    finished("2025_12", "c", "2026-04-01 10:00:00")
    assert readers.latest_month(spark, out, "1970-01").first()["month"] == "2026-02"
    finished("2026_01", "d", "2026-04-01 11:00:00")
    assert readers.latest_month(spark, out, "1970-01").first()["month"] == "2026-01"
    finished("2026_01", "c", "2026-04-01 11:00:00")
    assert publish.committed(spark, out, "2026_01").run == "d"
    assert publish.current(publish.ledger(spark, out)).count() == 3


def test_published_files_are_files(spark, tmp_path):
    table = spark.sql("SELECT 'a, b' AS x, 1.5D AS y, CAST(NULL AS STRING) AS z")
    run = publish.begin(spark, str(tmp_path), LABEL)
    path = run.kpi(table, readers.SPEED)
    assert open(path).read() == 'x,y,z\n"a, b",1.5,\n'
    assert open(sinks.write_csv(table.limit(0), path)).read() == "x,y,z\n"
    assert json.loads(open(run.report(table, readers.AUDIT)).read()) == {"x": "a, b", "y": 1.5}
    assert sorted(f for f in os.listdir(f"{run.folder}/outputs") if not f.startswith(".")) == [
        f"{readers.SPEED}_{LABEL}.csv", f"{readers.AUDIT}_{LABEL}.json"]


def test_a_run_that_fails_leaves_the_month(spark, make_trips, make_zones, tmp_path, january, monkeypatch):
    out, trips = str(tmp_path / "out"), make_trips(*_month_of_trips(1, 200, 4))
    done = run_month(january, trips, make_zones(), out)
    before = _tables(done), publish.read_table(spark, out, "fct_trips", LABEL).count()
    scratch = os.listdir(spark.conf.get("spark.checkpoint.dir"))

    def broken(*_):
        raise RuntimeError("a lost cluster")

    for place, name in ((kpis, "executive_summary_of"), (gate, "rollup_of"), (gate, "audit_report")):
        with monkeypatch.context() as patched, pytest.raises(RuntimeError, match="lost"):
            patched.setattr(place, name, broken)
            run_month(january, trips.limit(50), make_zones(), out)
        assert publish.committed(spark, out, LABEL).folder == done.folder
        assert (_tables(done), publish.read_table(spark, out, "fct_trips", LABEL).count()) == before
        assert readers.read_audit(spark, out, LABEL).first()["total_records"] == 200
    assert os.listdir(spark.conf.get("spark.checkpoint.dir")) == scratch
    again = run_month(january, trips.limit(50), make_zones(), out)
    assert readers.read_audit(spark, out, LABEL).first()["total_records"] == 50
    assert publish.expire(spark, out, LABEL) == 4
    assert os.listdir(f"{out}/runs/{LABEL}") == [os.path.basename(again.folder)]


def test_scratch_is_the_named_shared_folder(spark):
    folder = sinks.scratch_folder(spark)
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert folder != sinks.scratch_folder(spark)


def _month_of_trips(month: int, n: int, seed: int) -> list[dict]:
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        begin = datetime(2026, month, rng.randint(1, 28), rng.randint(0, 23))
        rows.append(
            trip(
                VendorID=rng.choice([1, 2, 5, 7]),
                tpep_pickup_datetime=begin,
                tpep_dropoff_datetime=begin + timedelta(seconds=rng.randint(0, 3000)),
                trip_distance=rng.randint(0, 900) / 100,
                PULocationID=rng.randint(1, 265),
                DOLocationID=rng.randint(1, 265),
                total_amount=rng.randint(-100, 9000) / 100,
            )
        )
    return rows


def _tables(done) -> dict:
    return {name: open(path).read() for name, path in done.kpis.items()}


def test_a_rerun_replaces_whatever_is_left(spark, make_trips, tmp_path):
    trips, out = make_trips(trip(), trip()), str(tmp_path)

    def write(rows, label):
        run = publish.begin(spark, out, label)
        written = run.table(rows, "t", rebalance=True)
        run.commit()
        return written

    write(trips, LABEL)
    write(trips.limit(1), "2026_02")
    for rows in (trips.limit(0), trips, trips.limit(1)):
        written = write(rows, LABEL)
        assert written.count() == publish.read_table(spark, out, "t", LABEL).count() == rows.count()
    assert publish.read_table(spark, out, "t", "2026_02").count() == 1


def test_the_quarantine_is_not_moved(make_trips, make_zones, tmp_path, january, monkeypatch):
    """It is tagged and written where its rows are read: no exchange, and no sort for one."""
    plans, real = {}, staged

    def spied(df, folder, name, **options):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return real(df, folder, name, **options)

    monkeypatch.setattr(sinks, "staged", spied)
    run_month(january, make_trips(*_month_of_trips(1, 50, 3)), make_zones(), str(tmp_path))
    assert "Scan parquet" in plans["quarantined_trips"]
    assert "Exchange" not in plans["quarantined_trips"] and "Sort" not in plans["quarantined_trips"]


def test_one_empty_file_is_refused(make_trips, tmp_path):
    path = str(tmp_path / "trips")
    make_trips(trip()).write.parquet(path)
    make_trips(trip()).limit(0).write.mode("append").parquet(path)
    with pytest.raises(readers.IncompleteSource, match="holds no rows"):
        manifest.verified_trips(make_trips().sparkSession, path)


def test_two_months_and_a_rerun(spark, make_trips, make_zones, tmp_path):
    out, zones = str(tmp_path), make_zones()
    january, february = Profile.month("2026-01"), Profile.month("2026-02")
    first = make_trips(*_month_of_trips(1, 400, 1), trip(tpep_pickup_datetime=datetime(2025, 12, 31)))
    second = make_trips(*_month_of_trips(2, 300, 2))
    done = run_month(january, first, zones, out)
    before = _tables(done)
    run_month(february, second, zones, out)
    done = run_month(january, first, zones, out, one_scan=True)

    assert _tables(done) == before
    audit = done.audit.first()
    assert audit["total_records"] == 401 and audit["out_of_period"] == 1
    assert audit["clean_records"] + audit["quarantined_records"] == 401

    fact = publish.read_table(spark, out, "fct_trips", LABEL)
    assert len(fact.columns) == 31 and fact.count() == audit["clean_records"]
    ids = sorted(r["trip_id"] for r in fact.select("trip_id").collect())
    assert ids == list(range(1, audit["clean_records"] + 1))
    assert publish.read_table(spark, out, "fct_trips", "2026_02").count() > 0
    held = publish.read_table(spark, out, "quarantined_trips", LABEL)
    assert held.count() == audit["quarantined_records"] and len(held.columns) == 34
    files = [f for f in os.listdir(f"{done.folder}/quarantined_trips") if f.endswith(".parquet")]
    assert len(files) == 1
    assert held.filter("total_violations = 0 OR quarantine_reasons = ''").count() == 0

    report = readers.read_audit(spark, out, LABEL).first()
    assert report["total_records"] == 401
    assert report["violations_by_rule"]["out_of_period"] == 1
    assert report["fde_assumptions_and_policy"] == POLICY
    for name, columns in readers.PUBLISHED.items():
        header = open(done.kpis[name]).readline().strip().split(",")
        assert header == [c.split()[0] for c in columns.split(", ")], name
    series = month_report(spark, out, january, ["Manhattan", "Queens"])
    assert {name for name, frame in series.items() if frame.isEmpty()} == {"top_sources", "top_sinks"}
    assert series["speed_series"].count() == 2
    with pytest.raises(readers.MissingOutput):
        month_report(spark, out, Profile.month("2026-03"))
    executive = readers.read_kpi(spark, out, readers.EXECUTIVE, LABEL).first()
    assert executive["clean_trip_volume"] == audit["clean_records"]
    assert {os.path.basename(p) for p in done.kpis.values()} == {
        f"{name}_{LABEL}.csv" for name in done.kpis
    }
    assert sorted(os.listdir(done.folder)) == [
        "dim_payment_types", "dim_rate_codes", "dim_vendors", "dim_zones", "fct_trips", "outputs",
        "quarantined_trips", "vendor_rollup",
    ]
    assert readers.latest_month(spark, out, "1970-01").first()["month"] == "2026-01"


def test_incomplete_zones_stop_the_run(make_trips, make_zones, tmp_path, january):
    with pytest.raises(readers.IncompleteSource):
        run_month(january, make_trips(trip()), make_zones().limit(9), str(tmp_path))
    assert not os.listdir(tmp_path)
