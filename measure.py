
from __future__ import annotations

import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from functools import reduce  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402

from checks import fixtures as fx  # noqa: E402
from checks import queries as q  # noqa: E402
from checks.compare import session  # noqa: E402
from floorwatch.config import MINIS_FLOOR  # noqa: E402
from floorwatch.functions.text import plain  # noqa: E402
from floorwatch.operators import floors, match, packs, track, windows  # noqa: E402
from floorwatch.sources import files, store  # noqa: E402
from floorwatch.sources.shared import fresh_path, materialise  # noqa: E402

REPEATS = int(os.environ.get("MEASURE_REPEATS", "3"))


def timed(label: str, build) -> None:
    taken = []
    for _ in range(REPEATS + 1):
        start = time.perf_counter()
        df = build()
        if df is not None:
            df.write.format("noop").mode("overwrite").save()
        taken.append(time.perf_counter() - start)
    print(f"{label:55s} {statistics.median(taken[1:]):8.2f} s", flush=True)


def long_names(spark, sf_dir):
    """Many different part names, by brand, type, size and pack."""
    parts = fx.table(spark, sf_dir, "part")
    base = F.concat_ws(" ", "p_name", "p_brand", "p_type", "p_size", "p_partkey")
    spelled = F.explode(F.array(*[F.lit(s) for s in fx.PACK_NAMES[:5]])).alias("spelled")
    return parts.select(base.alias("base"), spelled).select(
        F.replace(F.col("spelled"), F.lit("{}"), F.col("base")).alias("name")
    )


def long_mapping(spark, sf_dir, rows: int):
    base = F.concat_ws(" ", "p_name", "p_brand", "p_type", "p_size", "p_partkey")
    parts = fx.table(spark, sf_dir, "part").orderBy("p_partkey").limit(rows)
    return parts.select(
        base.alias("ProductName"), base.alias("SKUName"), F.lit("Top 58").alias("Status")
    )


def nested_loop(names, mapping):
    dim = match.mapping_columns(mapping).withColumn("pattern", plain(F.col("mappedName")))
    return names.join(F.broadcast(dim), plain(F.col("name")).contains(F.col("pattern")))


def clear_by_predicate(existing, given):
    inside = [
        (F.lower("account") == a) & F.col("date").between(F.lit(s), F.lit(e))
        for a, (s, e) in given.items()
    ]
    return existing.filter(~reduce(lambda a, b: a | b, inside))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    shared = tempfile.mkdtemp(prefix="measure-")
    spark.sparkContext.setCheckpointDir(shared)
    parts = sys.argv[2:] or ["floors", "contains", "many", "clear", "files", "outputs"]
    for part in parts:
        {
            "floors": measure_floors,
            "contains": measure_contains,
            "many": measure_many,
            "clear": measure_clear,
            "files": measure_files,
            "outputs": measure_outputs,
        }[part](spark, sf_dir)


def measure_floors(spark, sf_dir) -> None:
    matched = materialise(q._matched(spark, sf_dir), "matched")
    given = fx.floors(spark, sf_dir)
    for name in ("floor_union", "floor_single_pass", "floor_range"):
        lookup = getattr(floors, name)
        timed(name, lambda: lookup(matched, given.statics, given.weekly, MINIS_FLOOR))


def measure_contains(spark, sf_dir) -> None:
    names = materialise(long_names(spark, sf_dir), "names")
    print("distinct names", names.distinct().count())
    for rows in (60, 1000):
        mapping = materialise(long_mapping(spark, sf_dir, rows), "mapping")
        timed(f"nested loop contains, {rows} mapped names", lambda: nested_loop(names, mapping))
        timed(f"gram contains, {rows} mapped names", lambda: match.contains_pairs(names, mapping))


def measure_many(spark, sf_dir) -> None:
    """As many mapped names as names, sent to all tasks and shuffled, with and without the filter over grams."""
    names = materialise(long_names(spark, sf_dir).distinct(), "names")
    mapping = names.select(
        F.col("name").alias("ProductName"), F.col("name").alias("SKUName"), F.lit("Top 58").alias("Status")
    )
    print("mapped names", mapping.count())
    timed("gram contains, sent", lambda: match.contains_pairs(names, mapping))
    timed("gram contains, shuffled", lambda: match.contains_pairs(names, mapping, limit=0))
    filtered, match.may_be_anchored = match.may_be_anchored, lambda grams, _: grams
    timed("gram contains, shuffled without the filter", lambda: match.contains_pairs(names, mapping, limit=0))
    match.may_be_anchored = filtered


def measure_clear(spark, sf_dir) -> None:
    existing = materialise(fx.obs(spark, sf_dir), "track")
    for accounts in (11, 200):
        w = {
            f"shop {i}" if i >= 5 else r.lower(): (fx.FIRST_WEEK_DAY, fx.LAST_WEEK_DAY)
            for i, r in enumerate([*fx.REGION_COLUMNS, *range(accounts - 5)])
            for r in [str(r)]
        }
        frame = windows.windows_frame(spark, w)
        timed(f"clear by OR predicate, {accounts} accounts", lambda: clear_by_predicate(existing, w))
        timed(f"clear by anti-join, {accounts} accounts", lambda: windows.clear_windows(existing, frame))


def measure_files(spark, sf_dir) -> None:
    folder = fx.dated_folder(spark, sf_dir)
    df = files.read_window(spark, folder, fx.FILE_REGEX, q.START, q.END)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().apply(0)
    total = files.list_files(spark, folder, fx.FILE_REGEX).count()
    print("files opened by the window scan", plan.metrics().apply("numFiles").value(), "of", total)


def measure_outputs(spark, sf_dir) -> None:
    matched = materialise(q._matched(spark, sf_dir), "matched")
    given = fx.floors(spark, sf_dir)
    priced = floors.floor_single_pass(matched, given.statics, given.weekly, MINIS_FLOOR)
    raw = packs.raw_rows(priced, MINIS_FLOOR, cap=fx.CAP, packs=fx.PACKS)

    def two_outputs(parent):
        for df in (parent, packs.processed_rows(parent, MINIS_FLOOR)):
            track.final_view(df, MINIS_FLOOR).write.format("noop").mode("overwrite").save()

    def persisted():
        kept = raw.persist()
        two_outputs(kept)
        kept.unpersist(True)

    timed("raw and processed, parent recomputed", lambda: two_outputs(raw))
    timed("raw and processed, parent persisted", persisted)

    def one_pass():
        table = materialise(packs.both_outputs(raw, MINIS_FLOOR), "both", by=["_output"])
        for name in ("raw", "processed"):
            df = table.filter(F.col("_output") == name).drop("_output")
            track.final_view(df, MINIS_FLOOR).write.format("noop").mode("overwrite").save()

    timed("raw and processed, written in one pass", one_pass)

    rows = materialise(track.final_view(raw, MINIS_FLOOR), "sink").repartition(8)
    plain_rows = rows.withColumnRenamed(MINIS_FLOOR, "bfp")
    timed("sink, one file", lambda: plain_rows.coalesce(1).write.parquet(fresh_path(spark, "s")))
    timed("sink, parallel", lambda: plain_rows.write.parquet(fresh_path(spark, "s")))
    months = plain_rows.withColumn("date", F.trunc("date", "year"))
    timed(
        "sink, by account and date",
        lambda: store.arrange(months).write.partitionBy("account", "date").parquet(fresh_path(spark, "s")),
    )


if __name__ == "__main__":
    main()
