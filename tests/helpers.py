"""Builders for hand-made deliveries and drop files."""

from datetime import date, datetime

from pyspark.sql import functions as F

from dayledger.sources.schemas import EARLY_LAYOUT, LATE_LAYOUT, RAW, STAGING

EARLY = ",".join(EARLY_LAYOUT)
LATE = ",".join(LATE_LAYOUT)


def day(text):
    return None if text is None else date.fromisoformat(f"2026-{text}")


def delivery(
    drop="01-01", row=0, impressions=100.0, clicks=5.0, spend=2.5, conversions=1.0,
    event="01-01", campaign="cmp", adset="as", creative="cr", file=None, rate=None,
    creative_format="video", placement="feed",
):
    number = lambda v: None if v is None else float(v)
    return (
        day(event), campaign, adset, creative, creative_format, placement,
        number(impressions), number(clicks), number(spend), number(conversions), number(rate),
        row, datetime(2026, 6, 1), day(drop), file or (f"drop_2026-{drop}.csv" if drop else "x.csv"),
    )


def raw_rows(spark, rows):
    return spark.createDataFrame(rows, RAW)


def staged_row(
    creative="cr", impressions=2000, clicks=20, spend=2.5, conversions=1, event="01-01",
    campaign="cmp", adset="as", duplicate=False, creative_format="video", placement="feed",
):
    return (
        campaign, adset, creative, creative_format, placement, impressions, clicks,
        None if spend is None else float(spend), conversions, None, day(event), "drop.csv",
        duplicate, day(event),
    )


def staged_rows(spark, rows):
    return spark.createDataFrame(rows, STAGING)


def write_drop(folder, name, header, lines):
    with open(f"{folder}/{name}", "w", encoding="utf-8") as file:
        file.write("\n".join([header, *lines]) + "\n")


def comparable(rows, columns=None):
    """Rows as a sorted list of tuples."""
    columns = columns or sorted(rows.columns)
    return sorted((tuple(r) for r in rows.select(*columns).collect()), key=repr)


def write_drops(spark, raw, folder):
    """Deliveries as drop files: one per drop, in row order, late layout from its first rate on."""
    lines = raw.select(
        "_source_file",
        "_row_in_file",
        F.concat_ws(
            ",",
            *[
                F.coalesce(F.col(name).cast("string"), F.lit(""))
                for name in [*EARLY_LAYOUT, "video_completion_rate"]
            ],
        ).alias("line"),
    ).collect()
    files = {}
    for row in lines:
        files.setdefault(row["_source_file"], []).append((row["_row_in_file"], row.line))
    for name, content in files.items():
        late = name >= "drop_2026-02-20.csv"
        texts = [line if late else line.rsplit(",", 1)[0] for _, line in sorted(content)]
        write_drop(folder, name, LATE if late else EARLY, texts)
    return sorted(files)
