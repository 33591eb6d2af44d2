"""Metric feeds: nested JSON payloads to flat time series.

Every function takes rows with the response in column ``payload`` (JSON
text) and returns one row per asset, pool or point. Keys that are not
columns of their own stay available in a map, so nothing of a response is
lost. All of it is row-local: no shuffle except in :func:`price_ohlc`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (
    as_datetime,
    first_value,
    json_array,
    json_map,
    json_objects,
    json_objects_by_key,
    lookup,
    once,
    whole_number,
    without_keys,
)


def read_payloads(spark: SparkSession, path: str, **columns: str) -> DataFrame:
    """Landed responses, one JSON document per line, with literal columns added."""
    lines = spark.read.text(path).withColumnRenamed("value", "payload")
    return lines.withColumns({name: F.lit(value) for name, value in columns.items()})


def _field(name: str, source: str = "_item") -> Column:
    return lookup(F.col(source), F.lit(name))


def _number(name: str, source: str = "_item") -> Column:
    return _field(name, source).try_cast("double")


_CIRCULATING = {
    "circulating": "circulating",
    "circulatingPrevDay": "circulating_prev_day",
    "circulatingPrevWeek": "circulating_prev_week",
    "circulatingPrevMonth": "circulating_prev_month",
}


def stablecoins_metadata(payloads: DataFrame) -> DataFrame:
    """One row per asset with a peg type; amounts reduced to that peg's value."""
    others = [c for c in payloads.columns if c != "payload"]
    items = (
        payloads.select(*others, F.explode(json_objects(F.col("payload"), "peggedAssets")).alias("_item"))
        .withColumn("peg_type", _field("pegType"))
        .where("peg_type is not null and peg_type <> ''")
    )
    shown = ["pegType", "pegMechanism", "priceSource", "chains", "chainCirculating", *_CIRCULATING]
    amounts = [
        lookup(json_map(_field(name)), F.col("peg_type")).try_cast("double").alias(alias)
        for name, alias in _CIRCULATING.items()
    ]
    return items.select(
        *others,
        "peg_type",
        _field("pegMechanism").alias("peg_mechanism"),
        _field("priceSource").alias("price_source"),
        _field("chains").alias("chains"),
        *amounts,
        without_keys(F.col("_item"), shown).alias("other_fields"),
    )


def protocol_data(payloads: DataFrame) -> DataFrame:
    """One row per protocol; list fields as JSON text, two keys renamed."""
    others = [c for c in payloads.columns if c != "payload"]
    items = payloads.select(*others, json_map(F.col("payload")).alias("_item"))
    shown = ["chains", "audit_links", "audits", "defillamaId", "parentProtocol"]
    return items.select(
        *others,
        _field("defillamaId").alias("defillama_id"),
        _field("parentProtocol").alias("parent_protocol"),
        *[_field(name).alias(name) for name in ("chains", "audit_links", "audits")],
        without_keys(F.col("_item"), shown).alias("other_fields"),
    )


_BALANCES = ["chainBalances", "currentChainBalances"]


def _with_metadata(payloads: DataFrame, wanted: bool, series: list[str]) -> tuple[DataFrame, list[str]]:
    """The input columns, and the response's keys beside the series if wanted."""
    others = [c for c in payloads.columns if c != "payload"]
    if not wanted:
        return payloads, others
    return payloads.withColumn("metadata", without_keys(json_map(F.col("payload")), series)), [*others, "metadata"]


_HISTORY = "struct<tokens:array<struct<date:string,circulating:map<string,string>>>>"


def stablecoin_history(payloads: DataFrame, include_metadata: bool = False) -> DataFrame:
    """chain, circulating, timestamp for every point of every chain's history."""
    parsed, keep = _with_metadata(payloads, include_metadata, _BALANCES)
    balances = json_objects_by_key(F.col("payload"), "chainBalances", _HISTORY)
    points = parsed.select(*keep, F.explode(balances).alias("chain", "_chain")).select(
        *keep, "chain", F.explode("_chain.tokens").alias("_point")
    )
    return points.where(F.size("_point.circulating") > 0).select(
        *keep,
        "chain",
        whole_number(first_value(F.col("_point.circulating"))).alias("circulating"),
        as_datetime(F.col("_point.date")).alias("timestamp"),
    )


def stablecoin_current(
    payloads: DataFrame, as_of: Column | None = None, include_metadata: bool = False
) -> DataFrame:
    """chain, circulating at ``as_of`` (default now)."""
    parsed, keep = _with_metadata(payloads, include_metadata, _BALANCES)
    balances = json_objects_by_key(F.col("payload"), "currentChainBalances", "map<string,string>")
    now = F.unix_timestamp() if as_of is None else as_of
    amounts = parsed.select(*keep, F.explode(balances).alias("chain", "_amounts"))
    return amounts.where(F.size("_amounts") > 0).select(
        *keep,
        "chain",
        whole_number(first_value(F.col("_amounts"))).alias("circulating"),
        as_datetime(now).alias("timestamp"),
    )


_COIN = "struct<symbol:string,decimals:string,confidence:string,prices:array<map<string,string>>>"


def token_price(payloads: DataFrame) -> DataFrame:
    """Price points of ``network`` and ``contract_address`` (columns of the input).

    A point's own keys override the token's.
    """
    others = [c for c in payloads.columns if c != "payload"]
    key = F.concat("network", F.lit(":"), "contract_address")
    coin = lookup(json_objects_by_key(F.col("payload"), "coins", _COIN), key)
    points = payloads.select(*others, once(coin).alias("_coin")).select(
        *others, "_coin", F.explode("_coin.prices").alias("_point")
    )

    def own(name: str) -> Column:
        return F.when(F.map_contains_key("_point", name), _field(name, "_point")).otherwise(
            F.col(f"_coin.{name}")
        )

    rest = [c for c in others if c not in ("network", "contract_address")]
    base = {"network": F.col("network"), "contract_address": F.col("contract_address")}
    place = [
        F.when(F.map_contains_key("_point", n), _field(n, "_point")).otherwise(c).alias(n)
        for n, c in base.items()
    ]
    return points.select(
        *rest,
        *place,
        own("symbol").alias("symbol"),
        own("decimals").try_cast("int").alias("decimals"),
        own("confidence").try_cast("double").alias("confidence"),
        as_datetime(_field("timestamp", "_point")).alias("timestamp"),
        _number("price", "_point").alias("price"),
    )


def yield_pools(payloads: DataFrame) -> DataFrame:
    """One row per pool; token lists as JSON text, ``[]`` if missing."""
    others = [c for c in payloads.columns if c != "payload"]
    pools = payloads.select(*others, F.explode(json_objects(F.col("payload"), "data")).alias("_item"))
    texts = ["pool", "chain", "project", "symbol"]
    numbers = {"tvlUsd": "tvl_usd", "apy": "apy", "apyBase": "apy_base", "apyReward": "apy_reward"}
    shown = [*texts, *numbers, "rewardTokens", "underlyingTokens"]
    return pools.select(
        *others,
        *[_field(name).alias(name) for name in texts],
        *[_number(name).alias(alias) for name, alias in numbers.items()],
        F.coalesce(_field("rewardTokens"), F.lit("[]")).alias("reward_tokens"),
        F.coalesce(_field("underlyingTokens"), F.lit("[]")).alias("underlying_tokens"),
        without_keys(F.col("_item"), shown).alias("other_fields"),
    )


def yield_chart(payloads: DataFrame) -> DataFrame:
    """History of the pools named by ``pool_id`` and ``pool_name`` (columns of the input)."""
    others = [c for c in payloads.columns if c != "payload"]
    points = payloads.select(*others, F.explode(json_objects(F.col("payload"), "data")).alias("_item"))
    numbers = {"tvlUsd": "tvl_usd", "apy": "apy", "apyBase": "apy_base", "apyReward": "apy_reward"}
    return points.select(
        *others,
        as_datetime(_field("timestamp")).alias("timestamp"),
        *[_number(name).alias(alias) for name, alias in numbers.items()],
        without_keys(F.col("_item"), ["timestamp", *numbers]).alias("other_fields"),
    )


_REVENUE = ["totalDataChart", "totalDataChartBreakdown"]


def _revenue_points(payloads: DataFrame, series: str, include_metadata: bool) -> tuple[DataFrame, list[str]]:
    """Two-element points of a series as ``_at`` and ``_value``."""
    parsed, keep = _with_metadata(payloads, include_metadata, _REVENUE)
    text = F.col("payload")
    typed = F.from_json(text, f"struct<{series}:array<array<string>>>")[series]
    stepwise = F.transform(json_array(lookup(json_map(text), F.lit(series))), json_array)
    pairs = parsed.select(*keep, F.explode(F.coalesce(typed, stepwise)).alias("_pair"))
    return (
        pairs.where(F.size("_pair") == 2).select(
            *keep, F.get("_pair", F.lit(0)).alias("_at"), F.get("_pair", F.lit(1)).alias("_value")
        ),
        keep,
    )


def revenue_total(payloads: DataFrame, include_metadata: bool = False) -> DataFrame:
    """timestamp, revenue per point; ``protocol`` comes with the input."""
    points, keep = _revenue_points(payloads, "totalDataChart", include_metadata)
    return points.select(
        *keep, as_datetime(F.col("_at")).alias("timestamp"), F.col("_value").try_cast("double").alias("revenue")
    )


def revenue_breakdown(payloads: DataFrame, include_metadata: bool = False) -> DataFrame:
    """timestamp, chain, sub_protocol, revenue; values that are no objects drop out."""
    points, keep = _revenue_points(payloads, "totalDataChartBreakdown", include_metadata)
    chains = points.select(*keep, "_at", F.explode(json_map(F.col("_value"))).alias("chain", "_chain"))
    subs = chains.select(
        *keep, "_at", "chain", F.explode(json_map(F.col("_chain"))).alias("sub_protocol", "_revenue")
    )
    return subs.select(
        *keep,
        as_datetime(F.col("_at")).alias("timestamp"),
        "chain",
        "sub_protocol",
        F.col("_revenue").try_cast("double").alias("revenue"),
    )


def typed_price(prices: DataFrame) -> DataFrame:
    """Prices as stored: milliseconds and DECIMAL(38,9)."""
    return prices.withColumns(
        {"timestamp": F.date_trunc("millisecond", "timestamp").cast("timestamp_ntz"),
         "price": F.col("price").try_cast("decimal(38,9)")}
    )


def price_ohlc(prices: DataFrame, keys: list[str], period: str = "1 day") -> DataFrame:
    """Open, high, low, close per key and tumbling window.

    Points of one instant are ordered by price, so results repeat. First the
    points of an instant become its least and greatest price, then instants
    become bars: plain numbers in hash aggregates that combine before they
    move, so a token with most of the points is no bottleneck.
    """
    window = F.window("timestamp", period).alias("_w")
    instants = prices.select(*keys, window, "timestamp", "price").groupBy(*keys, "_w", "timestamp")
    instants = instants.agg(F.min("price").alias("_low"), F.max("price").alias("_high"))
    bars = instants.groupBy(*keys, "_w").agg(
        F.min_by("_low", "timestamp").alias("open"),
        F.max("_high").alias("high"),
        F.min("_low").alias("low"),
        F.max_by("_high", "timestamp").alias("close"),
    )
    return bars.select(*keys, F.col("_w.start").alias("timestamp"), "open", "high", "low", "close")
