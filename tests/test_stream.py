"""Recurring runs: only runs with a manifest count, late pages are left out, retries are safe."""

from __future__ import annotations

import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import DataFrameWriter, functions as F

from tallyshelf.plans import catalogue
from tallyshelf.sources import crawl
from tallyshelf.streaming import landing

SLUGS = ("audio", "power", "smart-office", "personal-care", "home-appliances")

AT = dt.datetime(2024, 5, 1, 6, 0)


def page(category, no, urls, total=2):
    tiles = "".join(f'<div class="js_product site-product"><a href="/product/{u}" data-name="{u}">x</a></div>' for u in urls)
    return (category, no, f"u{no}", 200, "text/html", f"Total {total} Pages{tiles}")


def land(spark, root, run, pages, landed=AT):
    rows = [(*p, landed, run) for p in pages]
    spark.createDataFrame(rows, landing.PAGE_TYPE).write.mode("append").partitionBy("run_id").parquet(f"{root}/pages")


def close(root, run, at=AT):
    folder = root / "manifests"
    folder.mkdir(exist_ok=True)
    line = {"run_id": run, "run_ts": "2024-05-01T06:30:00.000Z", "closed_at": f"{at + dt.timedelta(hours=1):%Y-%m-%dT%H:%M:%S.000Z}"}
    (folder / f"{run}.json").write_text(json.dumps(line))


def run_stream(spark, root):
    query = landing.catalogue_stream(
        spark, str(root), str(root / "out"), crawl.category_seeds(spark, SLUGS), "https://shop.example", runs_per_batch=1
    )
    query.awaitTermination(120)
    found = landing.landed(spark, str(root / "out"))
    return sorted((str(r["run_id"]), r["title"]) for r in found.collect())


def test_runs_are_processed_once_and_whole(spark, tmp_path):
    land(spark, tmp_path, "r1", [page("audio", 1, ["a", "b"]), page("audio", 2, ["b", "c"])])
    land(spark, tmp_path, "r1", [page("audio", 1, ["late"])], landed=AT + dt.timedelta(hours=2))
    land(spark, tmp_path, "r2", [page("audio", 1, ["a"])])
    close(tmp_path, "r1")
    assert run_stream(spark, tmp_path) == [("r1", "a"), ("r1", "b"), ("r1", "c")]
    late = landing.landed(spark, str(tmp_path / "out"), "late").collect()
    assert [(r["run_id"], r["late_pages"]) for r in late] == [("r1", 1)]
    close(tmp_path, "r2")
    assert run_stream(spark, tmp_path) == [("r1", "a"), ("r1", "b"), ("r1", "c"), ("r2", "a")]


def land_one(spark, root, *pages, metrics_table=None):
    """Runs r1 and r2 in one batch; r1 gets ``pages`` more."""
    if pages:
        land(spark, root, "r1", pages)
    runs = spark.createDataFrame([("r1", AT, AT), ("r2", AT, AT)], landing.MANIFEST_TYPE)
    seeds = crawl.category_seeds(spark, SLUGS)
    landing.land_runs(runs, f"{root}/pages", str(root / "out"), seeds, "https://shop.example", metrics_table)


def titles(spark, root):
    return sorted((r["run_id"], r["title"], r["category"]) for r in landing.landed(spark, str(root / "out")).collect())


def test_a_retried_batch_leaves_the_same_rows(spark, tmp_path):
    land_one(spark, tmp_path, page("power", 1, ["a"], total=1))
    land_one(spark, tmp_path)
    assert titles(spark, tmp_path) == [("r1", "a", "Power")]


@pytest.mark.parametrize("killed_in", ["write", "publish"])
def test_a_killed_batch_leaves_the_old_rows(spark, tmp_path, monkeypatch, killed_in):
    land_one(spark, tmp_path, page("power", 1, ["a"], total=1))

    def die(*_):
        raise KeyboardInterrupt

    write = DataFrameWriter.parquet
    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
        # Killed with all rows written, or after the snapshot and before the late pages.
        if killed_in == "publish":
            m.setattr(landing, "_publish", die)
        else:
            m.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: die() if "/late/" in path else write(self, path, *a, **k))
        land_one(spark, tmp_path, page("audio", 1, ["b"], total=1))
    assert titles(spark, tmp_path) == [("r1", "a", "Power")]
    assert len(list((tmp_path / "out" / "snapshot").glob("attempt=*"))) == 2
    landing.discard_unpublished(spark, str(tmp_path / "out"))
    assert titles(spark, tmp_path) == [("r1", "a", "Power")]
    land_one(spark, tmp_path)
    assert titles(spark, tmp_path) == [("r1", "a", "Power"), ("r1", "b", "Audio")]
    landing.discard_unpublished(spark, str(tmp_path / "out"))
    assert len(list((tmp_path / "out" / "snapshot").glob("attempt=*"))) == 1
    assert len(titles(spark, tmp_path)) == 2


def test_readers_open_published_attempts_only(spark, tmp_path):
    assert titles(spark, tmp_path) == []
    land_one(spark, tmp_path, page("power", 1, ["a"], total=1))
    land_one(spark, tmp_path)
    files = [f for f in landing.landed(spark, str(tmp_path / "out")).inputFiles() if "/snapshot/" in f]
    assert len({f.split("attempt=")[1].split("/")[0] for f in files}) == 1


def test_a_batch_counts_as_it_writes(spark, tmp_path):
    table = f"counts_{uuid.uuid4().hex[:8]}"
    land(spark, tmp_path, "r1", [page("audio", 1, ["late"])], landed=AT + dt.timedelta(hours=2))
    land_one(spark, tmp_path, page("audio", 1, ["a", "a", "b"]), page("audio", 2, ["b", "c"]), metrics_table=table)
    land_one(spark, tmp_path, metrics_table=table)
    rows = spark.table(table)
    assert rows.select("run").distinct().count() == 2
    counts = {(r["step"], r["counter"]): r["value"] for r in rows.select("step", "counter", "value").distinct().collect()}
    assert counts == {
        ("pages", "rows"): 2, ("tiles", "usable"): 5, ("new URLs", "rows"): 3, ("snapshot", "rows"): 4, ("late pages", "rows"): 1,
    }
    spark.sql(f"DROP TABLE {table}")


def test_stream_equals_batch(spark, tmp_path):
    pages = [page("audio", 1, ["a", "a"]), page("audio", 2, ["a"]), page("power", 1, []), page("power", 2, ["z"])]
    land(spark, tmp_path, "r9", pages)
    close(tmp_path, "r9")
    batch = catalogue.catalogue_snapshot(
        spark.read.parquet(f"{tmp_path}/pages").filter(F.col("run_id") == "r9"),
        crawl.category_seeds(spark, SLUGS), "https://shop.example", "2024-05-01 06:30:00",
    )
    assert run_stream(spark, tmp_path) == sorted(("r9", r["title"]) for r in batch.collect())
