"""Series from tables: daily bars, second assets, low-frequency rates, calendars, random placeholders, long to wide."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open, high, low, close and volume of orders by priority (the series) and day."""
    o = table(spark, sf_dir, "orders")
    price = F.col("o_totalprice")
    return o.groupBy(F.col("o_orderpriority").alias("series_id"), F.to_date("o_orderdate").alias("date")).agg(
        F.min_by(price, "o_orderkey").alias("open"), F.max(price).alias("high"), F.min(price).alias("low"),
        F.max_by(price, "o_orderkey").alias("close"), F.count("*").alias("volume"),
    )


def asset2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second series by day: mean extended price of what was shipped."""
    return table(spark, sf_dir, "lineitem").groupBy(F.to_date("l_shipdate").alias("date")).agg(F.avg("l_extendedprice").alias("asset"), F.avg("l_discount").alias("rate"))


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.groupBy(F.col("o_orderpriority").alias("series_id"), F.trunc(F.to_date("o_orderdate"), "month").alias("date")).agg(F.avg("o_totalprice").alias("low_freq"))


def calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row a day, both ends included."""
    return spark.sql(f"SELECT explode(sequence(DATE'{start}', DATE'{end}', INTERVAL 1 DAY)) AS date")


def random_series(spark: SparkSession, start: str, end: str, columns: list[str], seed: int = 0) -> DataFrame:
    """A placeholder source: seeded normal values for each day and column."""
    return calendar(spark, start, end).select("date", *[F.randn(seed + k).alias(c) for k, c in enumerate(columns)])


def daily_last(quotes: DataFrame, at: str, key: str, value: str) -> DataFrame:
    """The last quote of each day and key; `at` is a timestamp or a struct that starts with `ts` and breaks ties."""
    day = F.to_date(f"{at}.ts") if dict(quotes.dtypes)[at].startswith("struct") else F.to_date(at)
    return quotes.where(F.col(value).isNotNull()).groupBy(F.col(key), day.alias("date")).agg(F.max_by(F.col(value), F.col(at)).alias(value))


def wide(long: DataFrame, name: str, value: str, names: list[str]) -> DataFrame:
    """(date, name, value) rows to one column for each name; the mean where a name has several values a day."""
    return long.groupBy("date").pivot(name, names).agg(F.avg(value))


def series_json(spark: SparkSession, path: str) -> DataFrame:
    """Records {"data": "dd/MM/yyyy", "valor": text} to (date, value); what does not parse is NULL."""
    raw = spark.read.schema("data string, valor string").option("multiLine", True).json(path)
    return raw.select(F.expr("try_to_date(data, 'dd/MM/yyyy')").alias("date"), F.expr("try_cast(valor AS double)").alias("value"))


def quotes_json(spark: SparkSession, path: str) -> DataFrame:
    """Bid and ask records, several a day, to the day's last bid, ask and mid."""
    raw = spark.read.schema("dataHoraCotacao string, cotacaoCompra double, cotacaoVenda double").option("multiLine", True).json(path)
    q = raw.select(F.to_timestamp_ntz(F.col("dataHoraCotacao")).alias("ts"), F.struct(F.col("cotacaoCompra").alias("bid"), F.col("cotacaoVenda").alias("ask"), ((F.col("cotacaoCompra") + F.col("cotacaoVenda")) / 2).alias("mid")).alias("q"))
    return q.groupBy(F.to_date("ts").alias("date")).agg(F.max_by("q", "ts").alias("q")).select("date", "q.*")


def stored_range(spark: SparkSession, path: str, start: str | None = None, end: str | None = None, at: str = "date") -> DataFrame:
    """Stored series between two dates, both included; the filter reaches the Parquet scan."""
    df = spark.read.parquet(path)
    kind = dict(df.dtypes)[at]
    if start:
        df = df.where(F.col(at) >= F.lit(start).cast(kind))
    return df.where(F.col(at) < F.date_add(F.lit(end).cast("date"), 1).cast(kind)) if end else df


def latest(spark: SparkSession, path: str, days: int, at: str = "date") -> DataFrame:
    """Rows of the last `days` days that are there; the newest date is read from the column alone."""
    newest = spark.read.parquet(path).agg(F.date_sub(F.to_date(F.max(at)), days - 1).cast("string")).first()[0]
    return stored_range(spark, path, newest, at=at)


def spine(df: DataFrame, at: str = "date") -> DataFrame:
    """Every day from the first to the last of df."""
    ends = df.agg(F.to_date(F.min(at)).alias("a"), F.to_date(F.max(at)).alias("b")).where("a is not null")
    return ends.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 DAY"))).alias("date"))


def net_flows(long: DataFrame, name: str, value: str, names: list[str], total: str = "net") -> DataFrame:
    """One column for each name and their sum; a missing one counts nothing."""
    flows = wide(long, name, value, names)
    parts = [F.coalesce(F.col(f"`{n}`"), F.lit(0.0)) for n in names]
    return flows.withColumn(total, sum(parts[1:], parts[0]))


def last_quote(quotes: DataFrame, key: str, at: str, fields: list[str]) -> DataFrame:
    """The newest row of each key; its first field that is neither NULL nor 0 is the price."""
    newest = quotes.groupBy(key).agg(F.max_by(F.struct(*fields), at).alias("q"))
    return newest.select(key, F.coalesce(*[F.nullif(F.col(f"q.{f}"), F.lit(0)) for f in fields]).alias("price"))


def quote_spread(quotes: DataFrame, at: str, key: str, bid: str, ask: str) -> DataFrame:
    """Bid, ask and mid of the last quote of each key and day; `at` may be a struct that starts with `ts`."""
    day = F.to_date(f"{at}.ts") if dict(quotes.dtypes)[at].startswith("struct") else F.to_date(at)
    last = quotes.groupBy(F.col(key), day.alias("date")).agg(F.max_by(F.struct(F.col(bid).alias("bid"), F.col(ask).alias("ask")), F.col(at)).alias("q"))
    return last.select(key, "date", "q.bid", "q.ask", ((F.col("q.bid") + F.col("q.ask")) / 2).alias("mid"))


def option_chain(calls: DataFrame, puts: DataFrame) -> DataFrame:
    return calls.withColumn("type", F.lit("call")).unionByName(puts.withColumn("type", F.lit("put")), allowMissingColumns=True)
