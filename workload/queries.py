"""Registered queries: each runs a job of the library over whole driver tables."""

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from rulecast.functions.device_names import catalog_name, device_name
from rulecast.functions.numbers import as_number
from rulecast.functions.offers import (
    campaign_to_source,
    referrer_to_offer,
    referrer_to_source,
    tactic_to_offer,
)
from rulecast.functions.platform import fix_platform, platform_class
from rulecast.functions.text import clean_token, rule_text
from rulecast.operators.aggregates import ordered_concat
from rulecast.operators.dictionary import containing
from rulecast.operators.lineage import checkpoint_dir, materialize
from rulecast.operators.merging import override
from rulecast.operators.nested import unnest
from rulecast.plans import audience, catalog, clusters, feedback, feedback_state, jobs, offers, outcomes, reach_state, rules
from rulecast.plans.assignment import assign_devices
from rulecast.sources.readers import preview
from rulecast.sources.schemas import FEEDBACK
from rulecast.sources.writers import create_partitioned, write_day, write_days
from workload import inputs

RUN_DATE = "2017-02-01"
FIRST_DAY, LAST_DAY = "2024-01-01", "2024-12-31"
ONE_DAY = "2024-01-10"
OWN, OTHERS = ["OWN"], ["OTHER-0", "OTHER-1", "OTHER-2"]
RECENT = ("2024-01-16", "2024-02-29")
WINDOWS = (("2024-01-01", "2024-12-31"), ("2024-01-05", "2024-01-11"), RECENT)
PATTERNS = {
    "0": "(?i)(lumia 1|sm-small_(ring|bolt)|iris405)",
    "1_SS": "(?i)(samsung red|samsung blue|sm-red)",
    "2": "(?i)(iphone os 7|ipod|rv:4+0)",
    "3": "(?i)(sm-old_|sm-new_|th-th; samsung)",
    "9": "(?i)(no such device)",
}


def _scratch(spark, name):
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _control(spark, sf_dir):
    return offers.shape_offer_control(inputs.offers_raw(spark, sf_dir))


def _devices(spark, sf_dir):
    active = offers.active_offers(_control(spark, sf_dir), RUN_DATE)
    return offers.control_devices(active, inputs.properties(spark, sf_dir))


def _priced(spark, sf_dir):
    active = offers.active_offers(_control(spark, sf_dir), RUN_DATE)
    prices = materialize(offers.device_prices(inputs.properties(spark, sf_dir)))
    return offers.price_intervals(active, prices), prices


def _outcomes(spark, sf_dir):
    listed = materialize(offers.offer_list(_priced(spark, sf_dir)[0].offers))
    return listed, *rules.judged_offers(listed, inputs.feedback(spark, sf_dir))


def _rule_inputs(spark, sf_dir):
    return (
        _control(spark, sf_dir),
        inputs.properties(spark, sf_dir),
        inputs.feedback(spark, sf_dir),
    )


def offer_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _control(spark, sf_dir)


def active_offers(spark, sf_dir):
    return offers.active_offers(_control(spark, sf_dir), RUN_DATE)


def control_devices(spark, sf_dir):
    return _devices(spark, sf_dir)


def offer_list(spark, sf_dir):
    return offers.offer_list(_priced(spark, sf_dir)[0].offers)


def offer_activity(spark, sf_dir):
    history = inputs.feedback(spark, sf_dir)
    return outcomes.offer_activity(history, outcomes.device_totals(history))


def success_devices(spark, sf_dir):
    return outcomes.success_devices(_outcomes(spark, sf_dir)[1])


def landing_devices(spark, sf_dir):
    return outcomes.landing_devices(*_outcomes(spark, sf_dir)[1:])


def landing_override(spark, sf_dir):
    """Success lists with the landing list in their place where an offer has one."""
    _, judged, choices = _outcomes(spark, sf_dir)
    return override(
        outcomes.success_devices(judged), outcomes.landing_devices(judged, choices), "offer"
    )


def feedback_devices(spark, sf_dir):
    return outcomes.feedback_devices(*_outcomes(spark, sf_dir))


def channel_devices(spark, sf_dir):
    return rules.rule_tokens(*_rule_inputs(spark, sf_dir), RUN_DATE)


def daily_rules(spark, sf_dir):
    return rules.daily_rules(*_rule_inputs(spark, sf_dir), RUN_DATE)


def _feedback_state(spark, sf_dir):
    """The feedback taken in by halves; a part that was wrong at first is taken in anew.

    The table is partitioned by month here: what enters and leaves is a partition.
    """
    table, state = _scratch(spark, "feedback-table"), _scratch(spark, "feedback-state")
    month = [F.year("sighted_date").alias("year"), F.month("sighted_date").alias("month"), F.lit(1).alias("day")]
    rows = inputs.feedback(spark, sf_dir).select("*", *month)
    twice = F.when(F.col("year") == 1998, F.lit(2)).otherwise(F.lit(1))
    wrong = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), twice))).drop("_copy")
    write_days(wrong.select(*spark.createDataFrame([], FEEDBACK).columns), table)
    jobs.advance_feedback_state(spark, table, state, "1995-01-01", "1998-12-31")
    write_days(rows.where("year = 1998"), table)
    jobs.advance_feedback_state(spark, table, state, "1998-01-01", "2001-12-31")
    return feedback_state.read_state(spark, state)


def feedback_totals_from_state(spark, sf_dir):
    return _feedback_state(spark, sf_dir).totals()


def offer_activity_from_state(spark, sf_dir):
    state = _feedback_state(spark, sf_dir)
    return outcomes.activity(state.launch_days(), state.totals())


def daily_rules_from_state(spark, sf_dir):
    """The day's rules by the state of the feedback, without its history."""
    control, properties = _control(spark, sf_dir), inputs.properties(spark, sf_dir)
    return rules.daily_rules(control, properties, _feedback_state(spark, sf_dir), RUN_DATE)


def rules_one_day(spark, sf_dir):
    return rules.rules_one_day(*_rule_inputs(spark, sf_dir), RUN_DATE)


def price_only_rules(spark, sf_dir):
    """Rules from price ranges alone: no offer has feedback yet."""
    control, prices = _priced(spark, sf_dir)
    listed_terms = offers.offer_list(control.offers)
    nothing = listed_terms.select("offer").distinct().withColumn("dvc_techname", F.lit(None).cast("string"))
    return rules.build_rules(assign_devices(control, nothing, listed_terms, prices=prices))


def tap_feedback(spark, sf_dir):
    return feedback.tap_feedback(inputs.taps(spark, sf_dir), FIRST_DAY, LAST_DAY)


def tap_feedback_by_campaign(spark, sf_dir):
    return feedback.tap_feedback(
        inputs.taps(spark, sf_dir), FIRST_DAY, LAST_DAY, count_mode="event", tap_source="campaign"
    )


def event_feedback(spark, sf_dir):
    return feedback.event_feedback(inputs.tracked_events(spark, sf_dir), FIRST_DAY, LAST_DAY)


def feedback_backfill(spark, sf_dir):
    return feedback.daily_feedback(
        inputs.taps(spark, sf_dir), inputs.tracked_events(spark, sf_dir), FIRST_DAY, LAST_DAY
    )


def unnested_taps(spark, sf_dir):
    rows = unnest(
        inputs.taps(spark, sf_dir),
        b="header.incoming_ids",
        q="header.query_params",
        h="header.http_headers",
    )
    kept = rows.where((F.col("q.key") == "ext_cat") & (F.col("h.key") == "Referer"))
    return kept.groupBy("action_id", "tactic_id").agg(F.count("*").alias("n"))


def device_names(spark, sf_dir):
    agents = inputs.derive(spark, sf_dir, inputs.FLAT_TAPS)
    platform = fix_platform(F.col("platform"), F.col("user_agent"))
    agents = agents.select(platform.alias("platform"), "user_agent").distinct()
    name = device_name(F.col("platform"), F.col("user_agent"))
    return agents.select("*", name.alias("dvc_techname"))


def catalog_names(spark, sf_dir):
    agents = inputs.derive(spark, sf_dir, inputs.FLAT_SYNCS)
    agents = agents.select("platform", "user_agent").distinct()
    name = catalog_name(
        F.col("platform"), platform_class(F.col("platform")), F.col("user_agent")
    )
    return agents.select("*", name.alias("dvc_techname"))


def platform_classes(spark, sf_dir):
    taps = inputs.derive(spark, sf_dir, inputs.FLAT_TAPS)
    fixed = fix_platform(F.col("platform"), F.col("user_agent"))
    counted = taps.groupBy(fixed.alias("platform")).agg(F.count("*").alias("n"))
    return counted.withColumn("hl_platform", platform_class(F.col("platform")))


def tactic_offers(spark, sf_dir):
    taps = inputs.derive(spark, sf_dir, inputs.FLAT_TAPS)
    counted = taps.groupBy("tactic_id", "campaign_id").agg(F.count("*").alias("n"))
    return counted.select(
        "tactic_id",
        tactic_to_offer(F.col("tactic_id")).alias("offer"),
        campaign_to_source(F.col("campaign_id")).alias("source"),
        "n",
    )


def referrer_offers(spark, sf_dir):
    events = inputs.derive(spark, sf_dir, inputs.FLAT_EVENTS)
    counted = events.groupBy("referrer_url").agg(F.count("*").alias("n"))
    url = F.col("referrer_url")
    return counted.select(
        url, referrer_to_offer(url).alias("offer"), referrer_to_source(url).alias("source"), "n"
    )


def page_offers(spark, sf_dir):
    url = F.col("url")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select(
        "page_id",
        referrer_to_offer(url).alias("offer"),
        referrer_to_source(url).alias("source"),
        clean_token(F.lower(url)).alias("token"),
    )


def device_catalog(spark, sf_dir):
    return catalog.device_catalog(
        inputs.id_syncs(spark, sf_dir), "KIND_1", first_month=(2024, 1), last_month=(2024, 12)
    )


def _names(spark, sf_dir):
    return inputs.properties(spark, sf_dir).select(F.lower("dvc_techname").alias("dvc_techname"))


def match_catalog(spark, sf_dir):
    return catalog.match_catalog(_names(spark, sf_dir), inputs.atlas(spark, sf_dir))


def rank_lookup(spark, sf_dir):
    return catalog.attach_by_rank(match_catalog(spark, sf_dir), inputs.atlas(spark, sf_dir))


def device_properties(spark, sf_dir):
    return catalog.device_properties(match_catalog(spark, sf_dir), inputs.atlas(spark, sf_dir))


def price_imputation(spark, sf_dir):
    rows = inputs.properties(spark, sf_dir)
    name, price = F.col("dvc_techname"), F.col("release_price")
    return rows.select(name, catalog.impute_price(name, price).alias("release_price"))


def text_prices(spark, sf_dir):
    rows = inputs.properties(spark, sf_dir)
    price = as_number(F.col("release_price"))
    return rows.groupBy("dvc_techname").agg(
        F.count(price).cast("bigint").alias("priced"), F.max(price).alias("highest")
    )


def cluster_labels(spark, sf_dir):
    return clusters.cluster_brand(inputs.clusters(spark, sf_dir))


def cluster_brand_rules(spark, sf_dir):
    return clusters.cluster_rules(cluster_labels(spark, sf_dir))


def cluster_model_list(spark, sf_dir):
    return clusters.cluster_model_list(cluster_labels(spark, sf_dir))


def audience_competitors(spark, sf_dir):
    return audience.audience_competitors(inputs.sightings(spark, sf_dir), OTHERS)


def audience_recent_own(spark, sf_dir):
    return audience.audience_recent_own(inputs.sightings(spark, sf_dir), OWN, RECENT)


def audience_not_recent(spark, sf_dir):
    others = materialize(audience_competitors(spark, sf_dir))
    recent = materialize(audience_recent_own(spark, sf_dir))
    return audience.audience_not_recent(others, recent)


def cluster_reach(spark, sf_dir):
    return audience.cluster_reach(
        inputs.sightings(spark, sf_dir), PATTERNS, OWN, OTHERS, RECENT
    )


def _cluster_patterns(spark, sf_dir):
    """Cluster and pattern of the ten long rules."""
    tokens = inputs.derive(spark, sf_dir, inputs.CLUSTER_TOKENS)
    listed = ordered_concat(tokens.distinct(), ["cluster"], F.col("token"), "|", "tokens")
    return listed.select("cluster", F.concat(F.lit("(?i)("), "tokens", F.lit(")")).alias("pattern"))


def cluster_reach_long_rules(spark, sf_dir):
    """Reach by rules of hundreds of alternatives, found by their dictionary."""
    return audience.cluster_reach(
        inputs.sightings(spark, sf_dir), _cluster_patterns(spark, sf_dir), OWN, OTHERS, RECENT
    )


def agents_of_clusters(spark, sf_dir):
    """The clusters of each distinct user agent, by the same rules."""
    agents = inputs.sightings(spark, sf_dir)
    return containing(agents, "user_agent", _cluster_patterns(spark, sf_dir), "cluster", "pattern")


def _reach_state(spark, sf_dir, rules=None):
    """The state of all days, of which one is run again."""
    seen, numbers, state = (_scratch(spark, n) for n in ("seen", "numbers", "reach-state"))
    inputs.sightings(spark, sf_dir).write.parquet(seen)
    jobs.update_reach_state(spark, seen, numbers, state, FIRST_DAY, ONE_DAY, cluster_rules=rules)
    jobs.update_reach_state(spark, seen, numbers, state, ONE_DAY, LAST_DAY, cluster_rules=rules)
    return spark.read.parquet(state)


def _of_windows(reach):
    return reduce(DataFrame.unionByName, (reach(w).withColumn("first_day", F.lit(w[0])) for w in WINDOWS))


def model_reach_windows(spark, sf_dir):
    """Distinct ids per model in three windows, merged from the stored state of their days."""
    state = _reach_state(spark, sf_dir)
    return _of_windows(lambda w: reach_state.model_reach_of(state, w, "HARDWARE_IDFA", "Brand#2", "click"))


def cluster_reach_windows(spark, sf_dir):
    """Reach per cluster on other carriers but not the own one in three windows, from stored state."""
    rules = _scratch(spark, "long-rules")
    tokens = inputs.derive(spark, sf_dir, inputs.CLUSTER_TOKENS).distinct()
    listed = ordered_concat(tokens, ["cluster"], F.col("token"), "|", "tokens")
    listed.select(F.col("cluster").alias("cluster_brand"), rule_text(F.col("tokens")).alias("rule")).write.parquet(rules)
    state = _reach_state(spark, sf_dir, rules)
    return _of_windows(lambda w: reach_state.cluster_reach_of(state, OWN, OTHERS, w))


def model_reach(spark, sf_dir):
    return audience.model_reach(
        inputs.sightings(spark, sf_dir), "HARDWARE_IDFA", "Brand#2", "click", 2024
    )



def offer_control_file(spark, sf_dir):
    """The control file as CSV text with a title row in each part, read by position."""
    path = _scratch(spark, "offers-csv")
    rows = inputs.offers_raw(spark, sf_dir)
    title = {c: F.lit("Offer" if c == "offer" else c).alias(c) for c in rows.columns}
    titles = spark.range(1).select(*title.values())
    rows.select(*(F.col(c).cast("string") for c in rows.columns)).unionByName(titles).write.csv(path)
    table = _scratch(spark, "offers")
    jobs.upload_offer_control(spark, path, table)
    return spark.read.parquet(table)


def _faulty_offers(spark, sf_dir):
    """The control file with fields that are no numbers or days, and lines cut short or with a field more."""
    path = _scratch(spark, "faulty-csv")
    rows = inputs.derive(spark, sf_dir, inputs.FAULTY_OFFERS)
    title = spark.range(1).select(*(F.lit("Offer" if c == "offer" else c).alias(c) for c in rows.columns))
    rows.unionByName(title).write.csv(path)
    rows.where("apollo_price % 70 = 30").select(*rows.columns[:5]).write.mode("append").csv(path)
    rows.where("apollo_price % 70 = 40").withColumn("more", F.lit("x")).write.mode("append").csv(path)
    return path


def rejected_offer_fields(spark, sf_dir):
    """Every fault of a control file, with the offer whose line has it."""
    table, rejected = _scratch(spark, "offers"), _scratch(spark, "rejected")
    jobs.upload_offer_control(spark, _faulty_offers(spark, sf_dir), table, rejected=rejected)
    offer = F.substring_index("line", ",", 1).alias("offer")
    return spark.read.parquet(rejected).select(offer, "field", "value", "reason")


def accepted_offers(spark, sf_dir):
    """The table from the lines of a control file that have no fault."""
    table = _scratch(spark, "offers")
    jobs.upload_offer_control(spark, _faulty_offers(spark, sf_dir), table, strict=True)
    return spark.read.parquet(table)


def cluster_file(spark, sf_dir):
    """The cluster file as CSV text, to stored rules and model lists, read back."""
    path, out, models = (_scratch(spark, n) for n in ("clusters-csv", "cluster-rules", "models"))
    rows = inputs.clusters(spark, sf_dir)
    blank = [F.lit(None).cast("string").alias(n) for n in ("reach", "price", "year", "month", "time", "size", "px", "h", "w", "age")]
    laid_out = rows.select("model", blank[0], "marketing_name", "vendor", *blank[1:], F.col("cluster"))
    laid_out.write.option("ignoreTrailingWhiteSpace", False).option("ignoreLeadingWhiteSpace", False).csv(path)
    jobs.build_cluster_rules(spark, path, out, models=models)
    rules_, lists = spark.read.parquet(out), spark.read.parquet(models)
    return rules_.join(lists.withColumnRenamed("rule", "models"), "cluster_brand")


def _stored_feedback(spark, sf_dir):
    taps, events = _scratch(spark, "taps"), _scratch(spark, "events")
    inputs.taps(spark, sf_dir).write.parquet(taps)
    inputs.tracked_events(spark, sf_dir).write.parquet(events)
    return taps, events


def feedback_table(spark, sf_dir):
    """Backfill into a new table, a day written again, and the range once more: no row twice."""
    taps, events = _stored_feedback(spark, sf_dir)
    out = _scratch(spark, "feedback")
    create_partitioned(spark, out, FEEDBACK)
    jobs.backfill_feedback(spark, taps, events, out, FIRST_DAY, LAST_DAY)
    jobs.run_feedback(spark, taps, events, out, ONE_DAY)
    jobs.backfill_feedback(spark, taps, events, out, ONE_DAY, LAST_DAY)
    return spark.read.schema(FEEDBACK).parquet(out)


def feedback_one_day(spark, sf_dir):
    """The scan of one day's partitions."""
    taps, events = _stored_feedback(spark, sf_dir)
    out = _scratch(spark, "feedback-day")
    jobs.run_feedback(spark, taps, events, out, ONE_DAY)
    jobs.run_feedback(spark, taps, events, out, ONE_DAY, mode="append")
    return spark.read.schema(FEEDBACK).parquet(out)


def exported_rules(spark, sf_dir):
    """The day's rules, stored, exported as one ordered CSV file and read back with line numbers."""
    table, out = _scratch(spark, "rules"), _scratch(spark, "rules-csv")
    jobs.init_rules(spark, table)
    write_day(daily_rules(spark, sf_dir), table, RUN_DATE)
    jobs.export_rules(spark, table, out, RUN_DATE)
    lines = spark.read.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).csv(out)
    named = lines.toDF("source", "offer", "uc1_priority", "rule", "year", "month", "day")
    whole = [F.col(c).cast("int").alias(c) for c in ("uc1_priority", "year", "month", "day")]
    # A single file is read in its order.
    return named.coalesce(1).select("source", "offer", *whole, "rule", (F.monotonically_increasing_id() + 1).alias("line"))


def previewed_rules(spark, sf_dir):
    """How many rows a look at the day's rules shows."""
    return preview(daily_rules(spark, sf_dir), 10).agg(F.count("*").alias("n"))


QUERIES = {
    f.__name__: f
    for f in (
        offer_control,
        active_offers,
        control_devices,
        offer_list,
        offer_activity,
        success_devices,
        landing_devices,
        landing_override,
        feedback_devices,
        channel_devices,
        daily_rules,
        daily_rules_from_state,
        feedback_totals_from_state,
        offer_activity_from_state,
        rules_one_day,
        price_only_rules,
        tap_feedback,
        tap_feedback_by_campaign,
        event_feedback,
        feedback_backfill,
        unnested_taps,
        device_names,
        catalog_names,
        platform_classes,
        tactic_offers,
        referrer_offers,
        page_offers,
        device_catalog,
        match_catalog,
        rank_lookup,
        device_properties,
        price_imputation,
        text_prices,
        cluster_labels,
        cluster_brand_rules,
        cluster_model_list,
        audience_competitors,
        audience_recent_own,
        audience_not_recent,
        cluster_reach,
        cluster_reach_long_rules,
        agents_of_clusters,
        model_reach_windows,
        cluster_reach_windows,
        model_reach,
        offer_control_file,
        rejected_offer_fields,
        accepted_offers,
        cluster_file,
        feedback_table,
        feedback_one_day,
        exported_rules,
        previewed_rules,
    )
}
