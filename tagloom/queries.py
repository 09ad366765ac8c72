"""One query per operator over the tables of a data folder."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions import device, tags
from tagloom.functions.rules import AMOUNT, BRAND, CATEGORY, DEVICE, PAY_TIME, SEARCH
from tagloom.functions.scoring import with_scores
from tagloom.functions.timeparts import slot_of
from tagloom.operators import as_of, dimensions, interval_join, page_logs, parsing, profiles, repeats, snapshots, variants, weather
from tagloom.plans import adapters
from tagloom.plans import behavior_scores as behavior
from tagloom.plans import order_scores as orders
from tagloom.plans import user_tags as users
from tagloom.session import new_folder, written
from tagloom.sinks import files, packing, tables, upserts
from tagloom.sources.messages import replayed, spread
from tagloom.sources.tables import Tables
from tagloom.streaming import flows

AS_OF = dt.date(2024, 12, 31)

# Topics the change log is split into, by table.
ROUTES = {"user_info": "users", "user_info_sup": "supplements", "order_info": "orders", "order_detail": "details"}

RECORD = ["uid", "ts", *page_logs.PROFILE_FIELDS, "other_info"]
DETAIL_ARRIVAL = ["arrived_ms", "create_time", "sku_id", "sku_num", "order_price", "split_activity_amount"]
# So many small files are packed.
PACKED_FROM = 24
# A key's details are scanned by the week of their arrival.
DETAIL_SLOT_MS = 7 * 24 * 60 * 60 * 1000


def pay_time_slot(t: Tables) -> DataFrame:
    return adapters.order_info(t).select("id", "create_time", "pay_time_slot")


def score_time(t: Tables) -> DataFrame:
    rows = adapters.order_info(t).select("id", "pay_time_slot")
    return with_scores(rows, (PAY_TIME, "pay_time_slot"))


def score_amount(t: Tables) -> DataFrame:
    rows = adapters.order_detail(t).select("id", "order_price")
    return with_scores(rows, (AMOUNT, "order_price"))


def score_brand(t: Tables) -> DataFrame:
    return with_scores(order_enrich(t).select("detail_id", "tname"), (BRAND, "tname"))


def score_category(t: Tables) -> DataFrame:
    return with_scores(order_enrich(t).select("detail_id", "b1_name"), (CATEGORY, "b1_name"))


def score_device(t: Tables) -> DataFrame:
    judged = (
        adapters.log_records(t).groupBy("uid").agg(device.judged_system_agg(F.col("os")).alias("judge_os"))
    )
    return with_scores(judged, (DEVICE, "judge_os"))


def score_search(t: Tables) -> DataFrame:
    """Users by the one term they searched for; users with none or several match no category."""
    term = F.when(F.min("search_item") == F.max("search_item"), F.min("search_item"))
    rows = adapters.log_records(t).groupBy("uid").agg(term.alias("search_item"))
    found = dimensions.with_search_category(rows, adapters.searches(t))
    return with_scores(found, (SEARCH, "search_category")).select(
        "uid", "search_item", "b1_category", "search_category", *SEARCH.columns
    )


def age_group(t: Tables) -> DataFrame:
    years = tags.age(F.col("birthday"), AS_OF)
    return adapters.user_info(t).select("id", years.alias("age"), tags.age_group(years).alias("age_group"))


def zodiac(t: Tables) -> DataFrame:
    return adapters.user_info(t).select("id", tags.zodiac(F.col("birthday")).alias("constellation"))


def gender_tag(t: Tables) -> DataFrame:
    return _user_pairs(t).select("id", tags.gender(F.col("gender"), F.col("s_gender")).alias("gender"))


def body_metrics(t: Tables) -> DataFrame:
    return adapters.user_info_sup(t).select(
        "uid",
        tags.height_cm(F.col("height"), F.col("unit_height")).alias("height_cm"),
        tags.weight_kg(F.col("weight"), F.col("unit_weight")).alias("weight_kg"),
    )


def dim_category(t: Tables) -> DataFrame:
    return adapters.categories(t)


def dim_sku(t: Tables) -> DataFrame:
    return adapters.skus(t)


def order_enrich(t: Tables) -> DataFrame:
    details = adapters.order_detail(t).select(F.col("id").alias("detail_id"), "sku_id")
    return dimensions.with_product(details, adapters.products(t)).select(
        "detail_id", "sku_id", "c3id", "tname", "b1_name"
    )


def search_category(t: Tables) -> DataFrame:
    rows = adapters.log_records(t).select("uid", "ts", "search_item")
    return dimensions.with_search_category(rows, adapters.searches(t)).select(
        "uid", "ts", "search_item", "b1_category", "search_category"
    )


def broadcast_rules(t: Tables) -> DataFrame:
    return dimensions.adjusted_prices(adapters.priced_items(t), adapters.rates(t))


def rates_as_of(t: Tables) -> DataFrame:
    """Order lines at the rate that held at their own time."""
    return dimensions.prices_as_of(adapters.timed_items(t), adapters.timed_rules(t))


def dim_versions(t: Tables) -> DataFrame:
    return as_of.versions(adapters.sku_changes(t), "sku_id", "ts_ms", ["tname"], ["seq"], "deleted")


def order_enrich_as_of(t: Tables) -> DataFrame:
    """Order details with the brand their unit had when they were made."""
    details = adapters.order_detail(t).select(F.col("id").alias("detail_id"), "sku_id", "ts_ms")
    return as_of.with_version(details, written(dim_versions(t), "sku-versions"), "sku_id", "ts_ms")


def _captured_records(t: Tables) -> DataFrame:
    return snapshots.changes(adapters.capture_snapshot(t).unionByName(adapters.capture_log(t)), "user_info")


def cdc_handover(t: Tables) -> DataFrame:
    """Snapshot and later changes of customers, each of them once."""
    events = snapshots.handed_over(_captured_records(t), adapters.chunk_positions(t), adapters.chunk_of(F.col("row_key")))
    return events.select("row_key", "position", "op", "email")


def cdc_state(t: Tables) -> DataFrame:
    """Customers as of the end of the log, which begins after most of them were created."""
    messages = adapters.capture_snapshot(t).unionByName(adapters.capture_log(t))
    chunk = adapters.chunk_of(F.col("row_key"))
    return snapshots.table_state(messages, "user_info", adapters.chunk_positions(t), chunk).select(
        "id", "login_name", "name", "phone_num", "email", "gender"
    )


def _variant_rows(t: Tables) -> DataFrame:
    """Rows of all tables, each record parsed once."""
    return written(variants.variant_rows(adapters.any_table_log(t)), "variant-rows")


def cdc_variant(t: Tables) -> DataFrame:
    """Types met at every path of every table of the log, tables without a contract included."""
    # Read once, so each record is parsed once without being written.
    return variants.found_types(variants.variant_rows(adapters.any_table_log(t)))


def cdc_any_table(t: Tables) -> DataFrame:
    """Rows of a table without a contract, in the schema found for it."""
    rows = _variant_rows(t)
    schema = variants.schema_of(variants.found_types(rows.filter("source_table = 'spu_info'")), "spu_info")
    return variants.typed_rows(rows, "spu_info", schema).withColumn("price", F.col("price").cast("double"))


def _user_pairs(t: Tables) -> DataFrame:
    return interval_join.users_with_supplements(
        adapters.user_info(t), adapters.user_info_sup(t)
    )


def _pair_columns(pairs: DataFrame) -> DataFrame:
    return pairs.select("id", "name", "ts_ms", "s_uid", "s_ts_ms", "s_height", "s_weight")


def user_interval_join(t: Tables) -> DataFrame:
    return _pair_columns(_user_pairs(t))


def order_interval_join(t: Tables) -> DataFrame:
    return interval_join.orders_with_details(
        adapters.order_info(t), adapters.order_detail(t)
    )


def log_dedup(t: Tables) -> DataFrame:
    messages = adapters.redelivered(adapters.page_log_messages(t))
    return repeats.without_repeats(page_logs.device_and_search(page_logs.page_logs(messages)))


def detail_monotone(t: Tables) -> DataFrame:
    details = adapters.arriving_details(t)
    slot = slot_of(F.col("arrived_ms"), DETAIL_SLOT_MS)
    return repeats.rising_only(details, "id", "create_time", DETAIL_ARRIVAL, slot).select("id", "arrived_ms", "create_time")


def _records(t: Tables) -> DataFrame:
    return repeats.without_repeats(adapters.log_records(t))


def running_pv(t: Tables) -> DataFrame:
    rows = profiles.running_views(_records(t))
    return rows.select("uid", "ts", "os", "ch", "md", "ba", "pv")


def running_sets(t: Tables) -> DataFrame:
    rows = profiles.running_profile(_records(t))
    return behavior.profile_text(rows.select("uid", "ts", "pv", *[f"{name}_set" for name in page_logs.PROFILE_FIELDS]))


def window_last(t: Tables) -> DataFrame:
    rows = profiles.running_views(_records(t))
    kept = rows.select("uid", "ts", "os", "ch", "md", "ba", "pv")
    return profiles.last_in_window(kept, ["pv"])


def window_profile(t: Tables) -> DataFrame:
    return behavior.profile_text(profiles.windowed_profile(_records(t)))


def window_distinct(t: Tables) -> DataFrame:
    """How many different values a user has shown up to each window, by sketches of bounded size."""
    return profiles.windowed_distinct(_records(t))


def profile_values(t: Tables) -> DataFrame:
    return profiles.profile_values(_records(t))


def cdc_envelope(t: Tables) -> DataFrame:
    return parsing.envelope(adapters.change_log(t)).withColumnRenamed("table", "source_table")


def cdc_route(t: Tables) -> DataFrame:
    return parsing.route(adapters.change_log(t), ROUTES).select("topic", F.col("table").alias("source_table"), "ts_ms")


def cdc_quarantine(t: Tables) -> DataFrame:
    return parsing.quarantine(adapters.change_log(t).unionByName(adapters.dirty_log(t)))


def log_quarantine(t: Tables) -> DataFrame:
    return page_logs.quarantine(adapters.dirty_page_logs(t).unionByName(adapters.page_log_messages(t)))


def user_info_parse(t: Tables) -> DataFrame:
    rows = parsing.user_info(adapters.change_log(t))
    return rows.withColumn("birthday", F.date_format("birthday", "yyyy-MM-dd"))


def user_sup_parse(t: Tables) -> DataFrame:
    return parsing.user_info_sup(adapters.change_log(t))


def order_info_project(t: Tables) -> DataFrame:
    return parsing.order_info(adapters.change_log(t))


def order_detail_project(t: Tables) -> DataFrame:
    return parsing.order_detail(adapters.change_log(t))


def log_parse(t: Tables) -> DataFrame:
    common = F.col("common")
    return page_logs.page_logs(adapters.page_log_messages(t)).select(
        common["sid"].alias("sid"),
        common["uid"].alias("uid"),
        common["os"].alias("os"),
        F.col("page.item_type").alias("item_type"),
        F.col("page.item").alias("item"),
        "ts",
    )


def log_identity(t: Tables) -> DataFrame:
    return page_logs.identities(page_logs.page_logs(adapters.page_log_messages(t)))


def device_extract(t: Tables) -> DataFrame:
    return adapters.log_records(t)


def tombstone_filter(t: Tables) -> DataFrame:
    return parsing.drop_tombstones(adapters.page_log_messages(t))


def user_tags(t: Tables) -> DataFrame:
    """From change records to base tags."""
    rows = parsing.split(adapters.change_log(t), new_folder(t.spark, "user-rows"), "user_info", "user_info_sup")
    return users.user_tags(parsing.users_of(rows["user_info"]), parsing.supplements_of(rows["user_info_sup"]), AS_OF)


def tags_json(t: Tables) -> DataFrame:
    tagged = users.user_tags(adapters.user_info(t), adapters.user_info_sup(t), AS_OF)
    return parsing.as_messages(tagged)


def tag_records(t: Tables) -> DataFrame:
    """Base tags through their messages and back."""
    return parsing.tag_records(tags_json(t))


def behavior_scores(t: Tables) -> DataFrame:
    """From page-log messages, each delivered twice, to device and search scores per user and window."""
    messages = adapters.redelivered(adapters.page_log_messages(t))
    records = page_logs.device_and_search(page_logs.page_logs(messages))
    return behavior.behavior_scores(records, adapters.searches(t))


def order_scores(t: Tables) -> DataFrame:
    """From change records to scored order details."""
    return _scored_log(t, adapters.change_log(t))


def _scored_log(t: Tables, log: DataFrame) -> DataFrame:
    rows = parsing.split(log, new_folder(t.spark, "order-rows"), "order_info", "order_detail")
    return orders.order_scores(
        parsing.orders_of(rows["order_info"]), parsing.details_of(rows["order_detail"]), adapters.products(t)
    )


def order_versions(t: Tables) -> DataFrame:
    """Scored details of orders that have several records: the first pair to arrive wins."""
    return _scored_log(t, adapters.versioned_log(t))


def order_csv(t: Tables) -> DataFrame:
    """Scored order details through the CSV file and back."""
    scored = orders.order_scores(adapters.order_info(t), adapters.order_detail(t), adapters.products(t))
    path = new_folder(t.spark, "order-csv")
    files.write_order_csv(scored, path, compression="gzip")
    return files.read_order_csv(t.spark, path, scored.schema)


def order_csv_packed(t: Tables) -> DataFrame:
    """Scored order details in many small CSV files, packed by size and read back by the manifest."""
    met = interval_join.orders_with_details(adapters.order_info(t), adapters.order_detail(t), slot=orders.PAIR_MET)
    # Dealt out before the scores and names are added: half as wide.
    scored = orders.score_orders(spread(orders.first_pairs(met), PACKED_FROM), adapters.products(t))
    path = new_folder(t.spark, "order-csv")
    files.write_order_csv(scored, path, compression="gzip")
    packing.pack_files(t.spark, path, f"{path}-packed", idle_ms=0)
    return packing.read_packed(t.spark, f"{path}-packed", scored.schema)


def weather_upsert(t: Tables) -> DataFrame:
    """Weather rows of three readings merged by city, the last reading's batch before the second's and one replayed."""
    rows = written(weather_normalize(t), "weather-rows")
    reading = lambda n: rows.filter(F.col("code") % 3 >= n).withColumn("reading", F.lit(n))
    table = upserts.KeyedTable(t.spark, new_folder(t.spark, "weather-table"), reading(0).schema, ["code"], ["reading"])
    for batch_id, n in ((0, 0), (1, 2), (2, 1), (1, 2)):
        table.merge(reading(n), batch_id)
    return table.read()


def city_scan(t: Tables) -> DataFrame:
    return weather.cities(adapters.city_codes(t)).select("code", "province", "city", "area")


def weather_normalize(t: Tables) -> DataFrame:
    pieces = spread(adapters.weather_responses(t), t.spark.sparkContext.defaultParallelism)
    return weather.weather_rows(weather.outcomes(pieces))


def weather_failures(t: Tables) -> DataFrame:
    return weather.failures(weather.outcomes(adapters.weather_responses(t)))


def weather_summary(t: Tables) -> DataFrame:
    return weather.batch_summary(weather.outcomes(adapters.weather_responses(t)))


def weather_total(t: Tables) -> DataFrame:
    return weather.total_summary(weather_summary(t))


def weather_report(t: Tables) -> DataFrame:
    return weather.run_report(weather.outcomes(adapters.weather_responses(t)))


def weather_write(t: Tables) -> DataFrame:
    """Weather rows through the table sink and back."""
    rows = weather_normalize(t)
    path = new_folder(t.spark, "weather")
    tables.append_rows(rows, "parquet", path=path)
    return t.spark.read.schema(rows.schema).parquet(path)


def stream_user_join(t: Tables) -> DataFrame:
    rows = adapters.user_rows(adapters.streamed(t, "customer"))
    supplements = adapters.sup_rows(adapters.streamed(t, "customer", "supplements"))
    return flows.drained(_pair_columns(flows.users_with_supplements(rows, supplements)), "user-join")


def stream_user_tags(t: Tables) -> DataFrame:
    rows = parsing.user_info(adapters.user_records(adapters.streamed(t, "customer")))
    supplements = parsing.user_info_sup(adapters.sup_records(adapters.streamed(t, "customer", "supplements")))
    return flows.drained(flows.user_tags(rows, supplements, AS_OF), "user-tags")


def stream_tag_records(t: Tables) -> DataFrame:
    customers = adapters.streamed(t, "customer")
    messages = parsing.as_messages(
        users.tag_rows(
            interval_join.users_with_supplements(adapters.user_rows(customers), adapters.user_info_sup(t)), AS_OF
        )
    )
    return flows.drained(flows.tag_records(messages).drop("event_time"), "tag-records")


def stream_log_identity(t: Tables) -> DataFrame:
    messages = adapters.log_messages(adapters.streamed(t, "events"))
    return flows.drained(flows.identities(page_logs.page_logs(messages)).drop("event_time"), "log-identity")


def stream_order_join(t: Tables) -> DataFrame:
    rows = adapters.order_rows(adapters.streamed(t, "orders"))
    details = adapters.detail_rows(adapters.streamed(t, "lineitem"))
    return flows.drained(flows.orders_with_details(rows, details), "order-join")


def stream_order_scores(t: Tables) -> DataFrame:
    rows = parsing.order_info(adapters.order_records(adapters.streamed(t, "orders")))
    details = parsing.order_detail(adapters.detail_records(adapters.streamed(t, "lineitem")))
    scored = flows.order_scores(rows, details, adapters.products(t))
    return flows.drained(scored, "order-scores", close_windows=False)


def stream_order_versions(t: Tables) -> DataFrame:
    """Order updates as a stream: every order's records come in one batch, its details in another."""
    rows = parsing.order_info(adapters.order_versions(adapters.streamed(t, "orders")))
    details = parsing.order_detail(adapters.detail_records(adapters.streamed(t, "lineitem")))
    scored = flows.order_scores(rows, details, adapters.products(t))
    return flows.drained(scored, "order-versions", close_windows=False)


def stream_rates(t: Tables) -> DataFrame:
    """Orders and rules as one stream: an order waits until all rules of its time are in."""
    log = adapters.price_log(t)
    feed = replayed(log, "ts_ms", new_folder(t.spark, "stream-prices"), tail=adapters.closing_price(t))
    return flows.drained(flows.prices_as_of(feed), "rates")


def _streamed_records(t: Tables, twice: bool = False, closing: bool = False) -> DataFrame:
    """Page-log records in several batches, then some that come too late and count for nothing."""
    tail = adapters.late_events(t)
    if closing:
        tail = tail.unionByName(adapters.closing_event(t), allowMissingColumns=True)
    messages = adapters.log_messages(adapters.streamed(t, "events", tail=tail))
    if twice:
        messages = adapters.redelivered(messages)
    return page_logs.device_and_search(page_logs.page_logs(messages))


def stream_dedup(t: Tables) -> DataFrame:
    records = _streamed_records(t, twice=True)
    return flows.drained(flows.without_repeats(records).drop("event_time"), "dedup")


def stream_window_last(t: Tables) -> DataFrame:
    profile = flows.windowed_profile(_streamed_records(t, twice=True, closing=True))
    return flows.drained(behavior.profile_text(profile), "window-last")


def stream_behavior_scores(t: Tables) -> DataFrame:
    scored = flows.behavior_scores(_streamed_records(t, twice=True, closing=True), adapters.searches(t))
    return flows.drained(scored, "behavior-scores")


def stream_running_profile(t: Tables) -> DataFrame:
    rows = flows.running_profile(_streamed_records(t))
    return flows.drained(behavior.profile_text(rows), "running-profile")


def stream_arrival_window(t: Tables) -> DataFrame:
    """The last event of each user and window of arrival; the window of the closing event stays open."""
    closing = t["events"].filter("false").unionByName(adapters.closing_event(t), allowMissingColumns=True)
    feed = adapters.streamed(t, "events", "event arrivals", tail=closing)
    last = flows.last_in_arrival_window(adapters.arriving_events(feed), ["ts", "event_id"], arrived_ms="arrived_ms")
    return flows.drained(last, "arrival-window")


def stream_last_forgotten(t: Tables) -> DataFrame:
    """Orders that return with a lower time: passed once the last value is an hour old."""
    arrivals = adapters.returning_orders(t["orders"])
    feed = replayed(arrivals, "arrived_ms", new_folder(t.spark, "stream-returning"))
    return flows.drained(flows.rising_on_arrival(feed, "id", "create_time", ["arrived_ms"], "arrived_ms"), "last-forgotten")


def stream_late_counts(t: Tables) -> DataFrame:
    """Where the records of all micro-batches went: kept, repeated or late."""
    account = flows.deduplication_account(_streamed_records(t, twice=True), "late-counts")
    names = ("incoming", "kept", "repeated", "late")
    return account.agg(*[F.sum(name).alias(name) for name in names])


def stream_profile_resumed(t: Tables) -> DataFrame:
    """Running profiles: the older half of the log in a batch, the newer one as a stream that starts from it."""
    middle = adapters.middle_of_events(t)
    older = written(_records(t).filter(F.col("ts") <= middle), "older-records")
    known = profiles.running_profile(older).select("uid", "ts", "pv", *[f"{name}_set" for name in page_logs.PROFILE_FIELDS])
    newer = adapters.streamed(t, "events").filter(F.expr(f"{adapters.STREAM_TIMES['events']} > {middle}"))
    records = page_logs.device_and_search(page_logs.page_logs(adapters.log_messages(newer)))
    streamed = flows.running_profile(records, history=written(profiles.last_profile(older), "older-profiles"))
    return behavior.profile_text(known.unionByName(flows.drained(streamed, "profile-resumed")))


def state_values(t: Tables) -> DataFrame:
    """The last value passed for each detail, read from the state of the stopped stream."""
    # Keyed state takes every column through Python: only those that are asked for.
    details = adapters.arriving_detail_rows(adapters.streamed(t, "lineitem", "arrivals")).select("id", *DETAIL_ARRIVAL)
    kept = flows.rising_on_arrival(details, "id", "create_time", DETAIL_ARRIVAL, "arrived_ms", ttl_ms=10**12)
    checkpoint = flows.checkpoint_of(kept, "state-values")
    return flows.stored_entries(t.spark, checkpoint, "last", "id string, value bigint, passed_ms bigint")


def stream_detail_monotone(t: Tables) -> DataFrame:
    # Keyed state takes every column through Python: only those that are asked for.
    details = adapters.arriving_detail_rows(adapters.streamed(t, "lineitem", "arrivals")).select("id", *DETAIL_ARRIVAL)
    kept = flows.rising_only(details, "id", "create_time", DETAIL_ARRIVAL)
    return flows.drained(kept.select("id", "arrived_ms", "create_time"), "detail-monotone", close_windows=False)


def _over_folder(query: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: query(Tables(spark, folder))


BY_TABLES: dict[str, Callable[[Tables], DataFrame]] = {
    query.__name__: query
    for query in (
        pay_time_slot,
        score_time,
        score_amount,
        score_brand,
        score_category,
        score_device,
        score_search,
        age_group,
        gender_tag,
        body_metrics,
        zodiac,
        dim_category,
        dim_sku,
        order_enrich,
        search_category,
        broadcast_rules,
        rates_as_of,
        dim_versions,
        order_enrich_as_of,
        cdc_state,
        cdc_handover,
        cdc_variant,
        cdc_any_table,
        user_interval_join,
        order_interval_join,
        log_dedup,
        detail_monotone,
        order_versions,
        profile_values,
        log_quarantine,
        weather_failures,
        running_pv,
        running_sets,
        window_last,
        window_profile,
        window_distinct,
        cdc_envelope,
        cdc_route,
        cdc_quarantine,
        user_info_parse,
        user_sup_parse,
        order_info_project,
        order_detail_project,
        log_parse,
        log_identity,
        device_extract,
        tombstone_filter,
        tags_json,
        tag_records,
        user_tags,
        behavior_scores,
        order_scores,
        order_csv,
        order_csv_packed,
        city_scan,
        weather_normalize,
        weather_summary,
        weather_total,
        weather_report,
        weather_write,
        weather_upsert,
        stream_arrival_window,
        stream_last_forgotten,
        stream_late_counts,
        stream_profile_resumed,
        state_values,
        stream_rates,
        stream_user_join,
        stream_user_tags,
        stream_tag_records,
        stream_log_identity,
        stream_order_join,
        stream_order_scores,
        stream_order_versions,
        stream_dedup,
        stream_window_last,
        stream_behavior_scores,
        stream_running_profile,
        stream_detail_monotone,
    )
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: _over_folder(query) for name, query in BY_TABLES.items()
}
