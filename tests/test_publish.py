"""Published lists survive jobs that die; malformed lines; keyed upserts."""

import json
import os
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from counterfoil.operators import experiment
from counterfoil.sources import catalog, publish
from counterfoil.sources.binding import Retail
from counterfoil.sources.catalog import SCHEMAS
from counterfoil.sources.storage import store

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def rows(spark, n, start=0):
    return spark.range(start, start + n).select("id", (F.col("id") * 0.5).alias("x"), F.lit("a,b").alias("t"))


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_versions_replace_each_other(spark, tmp_path, fmt):
    root = str(tmp_path / "list")
    with pytest.raises(publish.NotPublished):
        publish.read_published(spark, root)
    first = publish.publish(rows(spark, 10), root, fmt, "one")
    second = publish.publish(rows(spark, 7, 100), root, fmt, "two")
    assert (first.rows, second.rows) == (10, 7) and publish.current(spark, root) == second
    got = publish.read_published(spark, root, check=True)
    assert sorted(map(tuple, got.collect())) == [(i, i * 0.5, "a,b") for i in range(100, 107)]
    assert publish.read_published(spark, root, first.version).count() == 10
    assert publish.roll_back(spark, root, first.version) == first
    assert publish.read_published(spark, root).count() == 10
    third = publish.publish(rows(spark, 0), root, fmt)
    assert third.rows == 0 and publish.read_published(spark, root, check=True).count() == 0
    assert [m.version for m in publish.versions(spark, root)] == [second.version, third.version]
    with pytest.raises(publish.NotPublished):
        publish.roll_back(spark, root, first.version)


def test_a_job_that_fails_leaves_the_old_list(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "list")
    publish.publish(rows(spark, 5), root)
    broken = rows(spark, 1000).withColumn(
        "x", F.when(F.col("id") == 999, F.raise_error(F.lit("dies"))).otherwise(F.col("x")).cast("double")
    )
    with pytest.raises(Exception, match="dies"):
        publish.publish(broken, root)
    assert publish.read_published(spark, root, check=True).count() == 5
    # Dies after the data and the manifest, just before the switch.
    monkeypatch.setattr(publish, "_switch", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        publish.publish(rows(spark, 6), root)
    monkeypatch.undo()
    assert publish.read_published(spark, root, check=True).count() == 5
    with pytest.raises(publish.BrokenVersion, match="expected 7"):
        publish.publish(rows(spark, 6), root, expected=7)
    assert publish.read_published(spark, root, check=True).count() == 5
    publish.publish(rows(spark, 8), root, keep=1, expected=8)
    assert publish.read_published(spark, root, check=True).count() == 8
    assert len([n for n in os.listdir(root) if n.startswith("v-")]) == 1


KILLED = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import functions as F
from counterfoil.session import build_session
from counterfoil.sources import publish
spark = build_session("killed", master="local[2]")
slow = spark.range(0, 2000, 1, 40).selectExpr(
    "id", "reduce(sequence(1, 3000000), 0D, (a, i) -> a + sqrt(i)) as x", "'t' as t"
)
publish.publish(slow, {root!r})
"""


def test_a_killed_job_leaves_the_old_list(spark, tmp_path):
    root = str(tmp_path / "list")
    publish.publish(rows(spark, 5), root)
    before = set(os.listdir(root))
    slow = KILLED.format(repo=REPO, root=root)
    job = subprocess.Popen([sys.executable, "-c", slow], start_new_session=True,
                           stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL)
    try:
        end = time.time() + 90
        while set(os.listdir(root)) == before and time.time() < end and job.poll() is None:
            time.sleep(0.2)
        time.sleep(1)
        assert job.poll() is None and set(os.listdir(root)) != before
    finally:
        os.killpg(job.pid, 9)
        job.wait()
    assert publish.read_published(spark, root, check=True).count() == 5
    publish.publish(rows(spark, 9), root)
    assert publish.read_published(spark, root, check=True).count() == 9
    assert len(publish.versions(spark, root)) == 2
    assert len([n for n in os.listdir(root) if n.startswith("v-")]) == 2


def test_changed_files_are_noticed(spark, tmp_path):
    root = str(tmp_path / "list")
    told = publish.publish(rows(spark, 50).repartition(3), root)
    data = tmp_path / "list" / told.version / "data"
    (part, *_) = sorted(data.glob("part-*.parquet"))
    part.unlink()
    with pytest.raises(publish.BrokenVersion):
        publish.read_published(spark, root)
    assert json.loads((tmp_path / "list" / told.version / "_MANIFEST").read_text())["rows"] == 50
    with pytest.raises(ValueError, match="kept"):
        publish.publish(rows(spark, 1), root, keep=0)


GOOD = "2026-05-01T10:00:00,P1,1.5,2,C1,,S,o1\n"
BAD = [
    "yesterday,P1,1.5,2,C1,,S,o1\n",  # no time
    "2026-05-01T10:00:00,P1,cheap,2,C1,,S,o1\n",  # no number
    "2026-05-01T10:00:00,P1,1.5,2\n",  # too few fields
    "2026-05-01T10:00:00,P1,1.5,2,C1,,S,o1,more\n",  # too many
    "2026-05-01T10:00:00,,1.5,2,C1,,S,o1\n",  # without a product
]


def test_malformed_lines_are_split_off(spark, tmp_path):
    head = "datetime,product_id,price,qty,customer_id,promotion_id,store_id,po_id\n"
    folder = tmp_path / "t.csv"
    folder.mkdir()
    (folder / "a.csv").write_text(head + GOOD * 30 + "".join(BAD))
    (folder / "b.csv").write_text(head + GOOD * 15)
    told = catalog.read_checked(spark, str(folder), SCHEMAS["transactions"], 0.5, catalog.KEYS["transactions"])
    assert (told.n_rows, told.n_rejected) == (45, 5)
    assert told.rows.count() == 45 and told.rows.columns == [f.split()[0] for f in SCHEMAS["transactions"].split(", ")]
    assert {r.qty for r in told.rows.select("qty").collect()} == {2}
    lines = told.rejects.collect()
    assert {r.file.rsplit("/", 1)[1] for r in lines} == {"a.csv"} and len(lines) == 5
    for r in lines[:4]:
        assert any(r.rejected_line.strip() == b.strip() for b in BAD) or ",P1," not in r.rejected_line
    (summary,) = catalog.reject_summary({"transactions": told}).collect()
    assert tuple(summary) == ("transactions", 45, 5)
    for limit in (0.05, 4):
        with pytest.raises(catalog.TooManyRejects, match="5 of 50"):
            catalog.read_checked(spark, str(folder), SCHEMAS["transactions"], limit, catalog.KEYS["transactions"])
    assert catalog.read_checked(spark, str(folder), SCHEMAS["transactions"], 5, catalog.KEYS["transactions"]).n_rejected == 5
    with pytest.raises(catalog.MissingInput, match="colour"):
        catalog.read_checked(spark, str(folder), "colour string")
    with pytest.raises(catalog.MissingInput, match="not found"):
        catalog.read_checked(spark, str(tmp_path / "none.csv"), "colour string")


def test_an_empty_table_has_no_rejects(spark, tmp_path):
    (tmp_path / "s.csv").write_text("store_id,store_taxonomies\n")
    told = catalog.read_checked(spark, str(tmp_path / "s.csv"), SCHEMAS["stores"])
    assert (told.n_rows, told.n_rejected, told.rows.count()) == (0, 0, 0)


LINES = "po_id string, product_id string, price double"


def test_upsert_is_idempotent_and_replaces_whole_orders(spark):
    history = spark.createDataFrame([("1", "A", 1.0), ("1", "B", 2.0), ("2", "A", 1.0), (None, "Z", 9.0)], LINES)
    lines = spark.createDataFrame([("1", "C", 3.0), ("PO_x", "A", 1.0), ("PO_x", "B", 1.0)], LINES)
    want = [(None, "Z", 9.0), ("1", "C", 3.0), ("2", "A", 1.0), ("PO_x", "A", 1.0), ("PO_x", "B", 1.0)]
    once = experiment.upsert_lines(history, lines)
    for df in (once, experiment.upsert_lines(once, lines)):
        assert sorted(map(tuple, df.collect()), key=repr) == sorted(want, key=repr)
    nothing = lines.limit(0)
    assert experiment.upsert_lines(history, nothing).count() == 4
    assert experiment.upsert_lines(history.limit(0), lines).count() == 3


def test_rerunning_a_stored_append_adds_nothing(spark, tmp_path):
    """The job as it is run: read what is published, put the campaign in, publish; twice."""
    root = str(tmp_path / "fact")
    publish.publish(spark.createDataFrame([("1", "A", 1.0)] * 3, LINES), root)
    lines = spark.createDataFrame([("PO_a", "A", 0.8), ("PO_b", "A", 1.0)], LINES)
    for _ in range(2):
        publish.publish(experiment.upsert_lines(publish.read_published(spark, root), lines), root)
        assert publish.current(spark, root).rows == 5


def test_few_new_orders_do_not_shuffle_the_fact_table(spark, small):
    retail = Retail(spark, small)
    lines = store(spark.createDataFrame([("PO_a", "A", 0.8)], LINES), "new-lines")
    history = retail.raw("lineitem").select(
        F.col("l_orderkey").alias("po_id"), F.lit("A").alias("product_id"), F.lit(1.0).alias("price"))
    plan = experiment.upsert_lines(history, lines)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
