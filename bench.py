"""Headline timings at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

$BENCH_COPIES repeats the wide source, to time the CSV load at the size of the
published load figure (14 copies at sf0.1 are 8.4 million rows).
"""

from __future__ import annotations

import json
import os
import re
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.operators import profile, reduce, views
from starfold.operators.reduce import Years
from starfold.plans import fixtures, importer
from starfold.plans.fixtures import spread
from starfold.plans.queries import SALES_HEADERS
from starfold.plans.store import Store
from starfold.session import fresh_dir, local_session, materialise

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
COPIES = int(os.environ.get("BENCH_COPIES", "1"))


def run(df: DataFrame) -> None:
    """Compute every row without keeping any."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session(CPUS, "bench")
    tables = fixtures.Tables(spark, SF_DIR)
    wide = spread(fixtures.wide_sales(tables))
    if COPIES > 1:
        wide = wide.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(COPIES)))).drop("_copy")
    staged = materialise(wide, "bench-staged")
    trade = materialise(spread(fixtures.wide_trade(tables)), "bench-trade")
    csv = fresh_dir(spark, "bench-csv")
    staged.toDF(*SALES_HEADERS).write.option("header", "true").option("quoteAll", "true").csv(csv)
    rows = staged.count()

    def new_store() -> Store:
        return Store(spark, fresh_dir(spark, "bench-store"))

    star = new_store()
    importer.import_frame(star, staged, "LI")
    layout = reduce.plan_layout(staged, "LI")
    clean = layout.clean(staged)
    view = importer.labelled(star, "LI")

    def merge_one_year() -> None:
        importer.import_frame(star, staged, "LI", years=Years.of(1998))

    def extract_dimensions() -> None:
        for group in layout.groups:
            run(reduce.dimension(clean, group, "LI"))

    timed: dict[str, Callable[[], object]] = {
        # CSV to star: line scan, one parse, profile, all tables written.
        "csv_load": lambda: importer.import_csv(new_store(), csv, "LI"),
        "infer_types": lambda: profile.infer_types(staged).collect(),
        "infer_types_trade": lambda: profile.infer_types(trade).collect(),
        "plan_layout": lambda: reduce.plan_layout(staged, "LI"),
        "constant_columns": lambda: run(
            profile.constant_columns(clean.select(*layout.reduced_columns))
        ),
        "dim_extract": extract_dimensions,
        "fact_reduced": lambda: run(clean.select(*layout.fact_columns)),
        "labelled_view": lambda: run(view),
        "series_one": lambda: run(
            views.series(
                view,
                {"area_label": "NATION_3", "element_label": "New"},
                ["year", "item_label", "value"],
            )
        ),
        "rehydrate": lambda: run(importer.rebuild_source(star, "LI")),
        "year_merge": merge_one_year,
    }
    seconds = {}
    for name, action in timed.items():
        action()  # compile and warm up
        start = time.perf_counter()
        action()
        seconds[name] = round(time.perf_counter() - start, 3)
    found = re.search(r"sf([0-9.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(found.group(1)) if found else None,
                "rows": rows,
                "csv_load_rows_per_second": round(rows / seconds["csv_load"]),
            }
        )
    )


if __name__ == "__main__":
    main()
