"""Jobs over stored tables: read inputs, run a plan, write its table.

Each job takes paths and a date. Without a date it runs for yesterday, the day that is complete.
"""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from rulecast.functions.dates import as_date, yesterday
from rulecast.functions.text import rule_pattern
from rulecast.operators.distinct_state import new_numbers
from rulecast.operators.lineage import materialize, scratch_tables
from rulecast.plans import audience, catalog, clusters, feedback, feedback_state, offers, reach_state, rules
from rulecast.sources.publishing import Published, replace_days, table_exists
from rulecast.sources.readers import check_device_clusters, check_offer_control, on_days, read_device_clusters, read_offer_control
from rulecast.sources.schemas import FEEDBACK, RULES
from rulecast.sources.writers import (
    create_partitioned,
    export_csv,
    replace_table,
    write_day,
)

# The titles of the exported files, and the first day of data.
RULE_TITLES = ["CHANNEL", " OFFER", " PRIORITY ORDER", " RULE", " YEAR", " MONTH", " DAY"]
CLUSTER_TITLES = ["CLUSTER", " RULE"]
FIRST_DAY = dt.date(2016, 8, 15)


def _day(run_date) -> dt.date:
    return yesterday() if run_date is None else as_date(run_date)


def upload_offer_control(
    spark: SparkSession, csv_path: str, out: str, rejected: str | None = None, strict: bool = False
) -> None:
    """Offer control file to a typed table.

    ``rejected`` is where the faults of the file go, if they are wanted. A field with a fault is NULL
    in the table; with ``strict`` its whole line stays out.
    """
    checked = check_offer_control(spark, csv_path, offers.offer_checks())
    raw = checked.rows if strict else read_offer_control(spark, csv_path)
    replace_table(offers.shape_offer_control(raw), out)
    if rejected is not None:
        replace_table(checked.rejected, rejected)


def run_feedback(
    spark: SparkSession, taps: str, events: str, out: str, run_date=None, mode="overwrite", **options
) -> None:
    """One day of feedback into its partition."""
    day = _day(run_date)
    table = feedback.daily_feedback(
        spark.read.parquet(taps), spark.read.parquet(events), day, **options
    )
    write_day(table, out, day, mode)


def backfill_feedback(
    spark: SparkSession, taps: str, events: str, out: str, start=FIRST_DAY, end=None, **options
) -> Published:
    """All days from ``start`` to ``end`` in one job; leaves what a run for each day would leave.

    Days whose feedback has changed are replaced; a day of the range that has none (any more) has no
    partition afterwards, and days outside the range stay as they are. The days change together: a
    run that stops leaves the old table or is finished by the next one.
    """
    first, last = as_date(start), _day(end)
    table = feedback.daily_feedback(
        spark.read.parquet(taps), spark.read.parquet(events), first, last, **options
    )
    return replace_days(table, out, first, last)


def init_feedback(spark: SparkSession, taps: str, events: str, out: str, **options) -> None:
    """A new feedback table with all days so far."""
    create_partitioned(spark, out, FEEDBACK)
    backfill_feedback(spark, taps, events, out, **options)


def build_device_properties(
    spark: SparkSession,
    id_syncs: str,
    atlas: str,
    out: str,
    id_type: str,
    first_month: tuple[int, int],
    last_month: tuple[int, int],
    **options,
) -> None:
    """Device names of the id syncs of some months, both ends included, with their properties."""
    atlas_table = spark.read.parquet(atlas)
    names = catalog.device_catalog(
        spark.read.parquet(id_syncs), id_type, first_month, last_month, **options
    )
    with scratch_tables(spark):
        matched = catalog.match_catalog(names, atlas_table)
        replace_table(catalog.device_properties(matched, atlas_table), out)


def run_daily_rules(
    spark: SparkSession,
    offer_control: str,
    properties: str,
    feedback_table: str,
    out: str,
    run_date=None,
    mode="overwrite",
    **options,
) -> None:
    """The day's rules into their partition."""
    day = _day(run_date)
    tables = (spark.read.parquet(p) for p in (offer_control, properties, feedback_table))
    with scratch_tables(spark):
        write_day(rules.daily_rules(*tables, day, **options), out, day, mode)


def advance_feedback_state(
    spark: SparkSession, feedback_table: str, state: str, start=None, end=None, history_start=None
) -> Published:
    """Take days of the feedback table, yesterday by default, into the state that rules can use.

    The state is made if there is none. Days may come in any order and again; ``history_start`` ends
    the part of days before it.
    """
    first = _day(start)
    last = first if end is None else as_date(end)
    rows = spark.read.schema(FEEDBACK).parquet(feedback_table)
    return feedback_state.advance(rows, state, first, last, history_start)


def run_daily_rules_from_state(
    spark: SparkSession,
    offer_control: str,
    properties: str,
    state: str,
    out: str,
    run_date=None,
    mode="overwrite",
    **options,
) -> None:
    """The day's rules into their partition, by the state of the feedback instead of its history."""
    day = _day(run_date)
    tables = (spark.read.parquet(p) for p in (offer_control, properties))
    with scratch_tables(spark):
        found = rules.daily_rules(*tables, feedback_state.read_state(spark, state), day, **options)
        write_day(found, out, day, mode)


def init_rules(spark: SparkSession, out: str) -> None:
    """A new, empty rules table."""
    create_partitioned(spark, out, RULES)


def run_rules_one_day(
    spark: SparkSession,
    offer_control: str,
    properties: str,
    feedback_table: str,
    out: str,
    run_date,
    **options,
) -> None:
    """Rules for one date as a table of their own."""
    tables = (spark.read.parquet(p) for p in (offer_control, properties, feedback_table))
    with scratch_tables(spark):
        replace_table(rules.rules_one_day(*tables, run_date, **options), out)


def rules_of_day(spark: SparkSession, table: str, day) -> DataFrame:
    """Read back one day's rules in export order."""
    rows = spark.read.schema(RULES).parquet(table).where(on_days(day))
    return rows.orderBy("source", "uc1_priority", "offer")


def export_rules(spark: SparkSession, table: str, out: str, run_date=None) -> None:
    """One day's rules as an ordered CSV file."""
    rows = spark.read.schema(RULES).parquet(table).where(on_days(_day(run_date)))
    export_csv(rows, out, ["source", "uc1_priority", "offer"], RULE_TITLES)


def build_cluster_rules(
    spark: SparkSession,
    csv_path: str,
    out: str,
    export: str | None = None,
    models: str | None = None,
    rejected: str | None = None,
) -> None:
    """Cluster file to rules per cluster label, as a CSV file too if asked for.

    ``models`` is where the list of models per label goes, in their own case, and ``rejected`` where
    the faults of the file go, if they are wanted.
    """
    if rejected is not None:
        replace_table(check_device_clusters(spark, csv_path).rejected, rejected)
    labelled = clusters.cluster_brand(
        clusters.shape_device_clusters(read_device_clusters(spark, csv_path))
    )
    replace_table(clusters.cluster_rules(labelled), out)
    if models is not None:
        replace_table(clusters.cluster_model_list(labelled), models)
    if export is not None:
        export_csv(spark.read.parquet(out), export, ["cluster_brand"], CLUSTER_TITLES)


def run_cluster_reach(
    spark: SparkSession,
    cluster_rules: str,
    dataset: str,
    out: str,
    own_carriers,
    other_carriers,
    own_window,
    **options,
) -> None:
    """Distinct ids of the audience per cluster label, by the patterns of stored cluster rules."""
    with scratch_tables(spark):
        patterns = _cluster_patterns(spark, cluster_rules)
        reach = audience.cluster_reach(
            spark.read.parquet(dataset), patterns, own_carriers, other_carriers, own_window, **options
        )
        replace_table(reach, out)


def run_model_reach(spark: SparkSession, dataset: str, out: str, *conditions, **options) -> None:
    """Distinct ids per model, most frequent first, under the conditions of ``model_reach``."""
    replace_table(audience.model_reach(spark.read.parquet(dataset), *conditions, **options), out)


def update_reach_state(
    spark: SparkSession,
    dataset: str,
    numbers: str,
    state: str,
    start=None,
    end=None,
    cluster_rules: str | None = None,
    id_column: str = "device_id",
    **options,
) -> None:
    """Add the sightings of some days, yesterday by default, to the stored state of reach.

    Only these days are read. ``numbers`` holds the number of every id so far, ``state`` one
    partition per day: of models, or with ``cluster_rules`` of the clusters by these rules. A day
    that is run again replaces its partition; a day without sightings has none afterwards. Numbers
    are stored before the state, so a run that stops in between is simply repeated.
    """
    first = _day(start)
    last = first if end is None else as_date(end)
    rows = spark.read.parquet(dataset).where(on_days(first, last))
    ids = f"id {rows.schema[id_column].dataType.simpleString()}, number bigint"
    if not table_exists(spark, numbers):
        spark.createDataFrame([], ids).write.parquet(numbers)
    with scratch_tables(spark):
        known = spark.read.schema(ids).parquet(numbers)
        new_numbers(rows, id_column, known).write.mode("append").parquet(numbers)
        known = spark.read.schema(ids).parquet(numbers)
        if cluster_rules is None:
            blocks = reach_state.model_days(rows, known, id_column, **options)
        else:
            patterns = _cluster_patterns(spark, cluster_rules)
            blocks = reach_state.cluster_days(rows, known, patterns, id_column=id_column, **options)
        replace_days(blocks, state, first, last)


def _cluster_patterns(spark: SparkSession, cluster_rules: str) -> DataFrame:
    pattern = rule_pattern(F.col("rule")).alias("pattern")
    return spark.read.parquet(cluster_rules).select(F.col("cluster_brand").alias("cluster"), pattern)


def build_audience(
    spark: SparkSession,
    dataset: str,
    out: str,
    own_carriers,
    other_carriers,
    window,
    id_column: str = "device_id",
) -> None:
    """Ids of other carriers that were not seen on the own ones within the window.

    Both lists are stored before they are compared: they are much smaller than the sightings, but
    Spark would otherwise compare first and make the result distinct afterwards.
    """
    rows = spark.read.parquet(dataset)
    with scratch_tables(spark):
        others = materialize(audience.audience_competitors(rows, other_carriers, id_column))
        recent = materialize(
            audience.audience_recent_own(rows, own_carriers, window, id_column=id_column)
        )
        replace_table(audience.audience_not_recent(others, recent, id_column), out)
