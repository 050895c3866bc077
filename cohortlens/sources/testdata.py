"""Map the bundled TPC-H-like test tables onto the reference's input tables (FIXTURES.md §2).

Every view is a lazy DataFrame derived from the parquet tables, so its size grows with the
scale factor. Column pruning and filters of later operators reach the parquet scans.

Fixed values of the mapping (must equal the DuckDB oracle views in ``plans/oracle.py``):
  device id       sid(k) = 'IDFV-cust-' || k when k % 3 = 0, else 'cust-' || k
  game name       'Shop' || ('QA' when k % 10 = 0) || '_' || c_mktsegment
  touch game      'Shop'
  utility game    'Shop'
  null publisher  o_orderpriority = '4-NOT SPECIFIED'
  revenue channel null for '4-NOT SPECIFIED', 'ADS' for '3-MEDIUM', else 'IAP'
  usa country     'NATION_1'
  rpi cents       d365 revenue / 10
  rating          50 * avg(l_discount) of lineitems shipped within 90 days
  facebook        c_mktsegment in ('BUILDING', 'HOUSEHOLD')
  paid source     an order with priority '1-URGENT' within 7 days of install
  returner        an order 1..90 days after install
  veteran         10 orders or more
  vip             c_acctbal >= 9000
  club member     c_acctbal > 0
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalar import money_sum, zero_pad_parts

USA_COUNTRY = "NATION_1"
FACEBOOK_SEGMENTS = ("BUILDING", "HOUSEHOLD")
PAID_PRIORITY = "1-URGENT"
NULL_PRIORITY = "4-NOT SPECIFIED"
ADS_PRIORITY = "3-MEDIUM"
RPI_CENTS_DIVISOR = 10
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def device_id(k: Column) -> Column:
    ks = k.cast("string")
    return F.when(k % 3 == 0, F.concat(F.lit("IDFV-cust-"), ks)).otherwise(F.concat(F.lit("cust-"), ks))


def game_name(k: Column, segment: Column) -> Column:
    return F.concat(F.lit("Shop"), F.when(k % 10 == 0, F.lit("QA")).otherwise(F.lit("")), F.lit("_"), segment)


@dataclass
class TestWorld:
    """Lazy views over one scale-factor directory."""

    spark: SparkSession
    sf_dir: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # ---- revenue-model world ------------------------------------------------------------
    @cached_property
    def _first_order(self) -> DataFrame:
        o = self.table("orders")
        return o.groupBy("o_custkey").agg(F.min(F.to_date("o_orderdate")).alias("install_dt"))

    @cached_property
    def installs(self) -> DataFrame:
        """Installs: s, install_dt, game_name, country, year, month, day."""
        c = self.table("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        n = self.table("nation").select("n_nationkey", "n_name")
        df = (
            self._first_order.join(c, F.col("o_custkey") == F.col("c_custkey"))
            .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                device_id(F.col("c_custkey")).alias("s"),
                "install_dt",
                game_name(F.col("c_custkey"), F.col("c_mktsegment")).alias("game_name"),
                F.col("n_name").alias("country"),
            )
        )
        return df.select("*", *zero_pad_parts(F.col("install_dt"), ("year", "month", "day")))

    @cached_property
    def installs_again(self) -> DataFrame:
        """Installs in which devices come back: every fifth order day counts as another install of its customer."""
        o = self.table("orders").where(F.col("o_orderkey") % 5 == 0)
        more = o.select(device_id(F.col("o_custkey")).alias("s"), F.to_date("o_orderdate").alias("again")).distinct()
        again = self.installs.join(more, "s").select("s", F.col("again").alias("install_dt"), "game_name", "country",
                                                     *zero_pad_parts(F.col("again"), ("year", "month", "day")))
        return self.installs.unionByName(again)

    @cached_property
    def touches(self) -> DataFrame:
        """Ad touches: adx_id, publisher_name, game_name, time_stamp, touch_id, yy, mm, dd."""
        o = self.table("orders")
        df = o.select(
            F.upper(F.concat(F.lit("cust-"), F.col("o_custkey").cast("string"))).alias("adx_id"),
            F.when(F.col("o_orderpriority") != NULL_PRIORITY, F.col("o_orderpriority")).alias("publisher_name"),
            F.lit("Shop").alias("game_name"),
            F.col("o_orderdate").alias("time_stamp"),
            F.col("o_orderkey").alias("touch_id"),
        )
        return df.select("*", *zero_pad_parts(F.to_date("time_stamp"), ("yy", "mm", "dd")))

    @cached_property
    def revenue(self) -> DataFrame:
        """Revenue: s, game_name, activity_date, amt, channel."""
        o = self.table("orders")
        c = self.table("customer").select("c_custkey", "c_mktsegment")
        pr = F.col("o_orderpriority")
        return o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
            device_id(F.col("o_custkey")).alias("s"),
            game_name(F.col("o_custkey"), F.col("c_mktsegment")).alias("game_name"),
            F.to_date("o_orderdate").alias("activity_date"),
            F.col("o_totalprice").alias("amt"),
            F.when(pr == NULL_PRIORITY, F.lit(None).cast("string"))
            .when(pr == ADS_PRIORITY, F.lit("ADS")).otherwise(F.lit("IAP")).alias("channel"),
        )

    @cached_property
    def _lines(self) -> DataFrame:
        li = self.table("lineitem").select("l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate", "l_partkey")
        o = self.table("orders").select("o_orderkey", "o_custkey")
        return li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))

    @cached_property
    def sessions(self) -> DataFrame:
        """Sessions: s, game_name, activity_date, session_length (one row per lineitem)."""
        c = self.table("customer").select("c_custkey", "c_mktsegment")
        # orders meet their customers first: lines, the largest table, are then dealt out once and not twice
        o = self.table("orders").select("o_orderkey", "o_custkey").join(c, F.col("o_custkey") == F.col("c_custkey"))
        li = self.table("lineitem").select("l_orderkey", "l_extendedprice", "l_shipdate")
        return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
            device_id(F.col("o_custkey")).alias("s"),
            game_name(F.col("o_custkey"), F.col("c_mktsegment")).alias("game_name"),
            F.to_date("l_shipdate").alias("activity_date"),
            F.col("l_extendedprice").alias("session_length"),
        )

    @cached_property
    def utility(self) -> DataFrame:
        """Utility per device and day: s, game_base, activity_date, utility (one row per device-day)."""
        return (
            self._lines.groupBy(device_id(F.col("o_custkey")).alias("s"), F.to_date("l_shipdate").alias("activity_date"))
            .agg(F.sum("l_quantity").alias("utility"))
            .select("s", F.lit("Shop").alias("game_base"), "activity_date", "utility")
        )

    # ---- player-value world (d7 -> d365) --------------------------------------------------
    @cached_property
    def _order_stats(self) -> DataFrame:
        """Per customer: spend at 7 / 365 days and overall, order count, paid flag, returner, tenure.
        Orders are first reduced to one row per (customer, day) with partial aggregation, so a customer
        holding a large share of all orders reaches the join with at most one row per day."""
        o = self.table("orders").select("o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority")
        daily = o.groupBy("o_custkey", F.to_date("o_orderdate").alias("d")).agg(
            F.sum(F.col("o_totalprice").cast("decimal(28,6)")).alias("amt"),
            F.count(F.lit(1)).alias("k"),
            F.max((F.col("o_orderpriority") == PAID_PRIORITY).cast("int")).alias("urgent"))
        j = daily.join(self._first_order, "o_custkey")
        age = F.datediff(F.col("d"), F.col("install_dt"))
        return j.groupBy("o_custkey", "install_dt").agg(
            F.sum(F.when(age <= 365, F.col("amt"))).cast("double").alias("spend_365"),
            F.sum(F.when(age <= 7, F.col("amt"))).cast("double").alias("spend_7"),
            F.sum("amt").cast("double").alias("spend_all"),
            F.sum("k").alias("submissions"),
            F.max(F.when(age <= 7, F.col("urgent")).otherwise(0)).alias("paid_source"),
            F.max(F.when((age >= 1) & (age <= 90), 1).otherwise(0)).alias("returner"),
            F.max(age).alias("tenure_days"),
        )

    @cached_property
    def _line_stats(self) -> DataFrame:
        """Per customer: lines shipped within 90 days, 50 x their mean discount, all lines; lines are
        reduced to one row per (customer, ship day) before the join."""
        daily = self._lines.groupBy("o_custkey", F.to_date("l_shipdate").alias("d")).agg(
            F.count(F.lit(1)).alias("k"),
            F.sum(F.col("l_discount").cast("decimal(28,6)")).alias("disc"),
            F.count("l_discount").alias("k_disc"))
        j = daily.join(self._first_order, "o_custkey")
        in90 = F.datediff(F.col("d"), F.col("install_dt")) <= 90
        return j.groupBy("o_custkey").agg(
            F.coalesce(F.sum(F.when(in90, F.col("k"))), F.lit(0)).alias("sessions"),
            (F.sum(F.when(in90, F.col("disc"))).cast("double") * 50 / F.sum(F.when(in90, F.col("k_disc")))).alias("rating"),
            F.sum("k").alias("lines_all"),
        )

    @cached_property
    def players(self) -> DataFrame:
        """raw_data: player_id, install_date, d365_RPI (cents), submissions, sessions, avg_rating_received,
        united_states, facebook_connected, paid_source, returner."""
        c = self.table("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        n = self.table("nation").select("n_nationkey", "n_name")
        return (
            self._order_stats.join(self._line_stats, "o_custkey", "left")
            .join(c, F.col("o_custkey") == F.col("c_custkey"))
            .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("o_custkey").alias("player_id"),
                F.col("install_dt").alias("install_date"),
                (F.col("spend_365") / RPI_CENTS_DIVISOR).alias("d365_RPI"),
                "submissions",
                F.coalesce(F.col("sessions"), F.lit(0)).alias("sessions"),
                F.col("rating").alias("avg_rating_received"),
                (F.col("n_name") == USA_COUNTRY).cast("int").alias("united_states"),
                F.col("c_mktsegment").isin(*FACEBOOK_SEGMENTS).cast("int").alias("facebook_connected"),
                "paid_source",
                "returner",
            )
        )

    @cached_property
    def spend(self) -> DataFrame:
        """spend_data (long form): player_id, category_name, pct_spend (share of spend per item type)."""
        p = self.table("part").select("p_partkey", "p_type")
        j = self._lines.select("o_custkey", "l_partkey", "l_extendedprice").join(p, F.col("l_partkey") == F.col("p_partkey"))
        # a player's total is the exact sum of the sums per type, of which there are as many as item types at most
        per_type = (j.where("o_custkey IS NOT NULL").groupBy("o_custkey", "p_type")
                    .agg(F.sum(F.col("l_extendedprice").cast("decimal(28,6)")).alias("type_spend")))
        total = F.sum("type_spend").over(Window.partitionBy("o_custkey"))
        return per_type.select(
            F.col("o_custkey").alias("player_id"),
            F.col("p_type").alias("category_name"),
            (F.col("type_spend").cast("double") / total.cast("double")).alias("pct_spend"),
        )

    # ---- user-base world (clustering) -------------------------------------------------------
    @cached_property
    def userbase(self) -> DataFrame:
        """userbase: s, install_dt, country, marketing_channel, veteran, vip, club_member, cumulative_revenue,
        ltv_7d (cents), tenure_days, avg_daily_sessions, map_of_spent, map_of_started (text maps)."""
        from ..functions.maps import format_map_text

        c = self.table("customer").select("c_custkey", "c_nationkey", "c_acctbal")
        n = self.table("nation").select("n_nationkey", "n_name")
        spent = format_map_text(self.spend, "player_id", "category_name", "pct_spend", "map_of_spent")
        ev = self.table("events").select("user_id", "event_type")
        per_type = ev.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("k"))
        per_user = per_type.groupBy("user_id").agg(F.sum("k").alias("n_events"))
        shares = per_type.join(per_user, "user_id").select(
            "user_id", "event_type", (F.col("k") / F.col("n_events")).alias("share"))
        started = format_map_text(shares, "user_id", "event_type", "share", "map_of_started")
        return (
            self._order_stats.join(self._line_stats, "o_custkey", "left")
            .join(c, F.col("o_custkey") == F.col("c_custkey"))
            .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(spent, F.col("o_custkey") == F.col("player_id"), "left")
            .join(started, F.col("o_custkey") == F.col("user_id"), "left")
            .select(
                device_id(F.col("o_custkey")).alias("s"),
                "install_dt",
                F.col("n_name").alias("country"),
                F.when(F.col("paid_source") == 1, F.lit("paid")).otherwise(F.lit("organic")).alias("marketing_channel"),
                (F.col("submissions") >= 10).cast("int").alias("veteran"),
                (F.col("c_acctbal") >= 9000).cast("int").alias("vip"),
                (F.col("c_acctbal") > 0).cast("int").alias("club_member"),
                F.col("spend_all").alias("cumulative_revenue"),
                (F.col("spend_7") * 100).alias("ltv_7d"),
                F.col("tenure_days"),
                (F.coalesce(F.col("lines_all"), F.lit(0)) / (F.col("tenure_days") + 1)).alias("avg_daily_sessions"),
                "map_of_spent",
                "map_of_started",
            )
        )

    # ---- campaign world (events) ------------------------------------------------------------
    @cached_property
    def daily(self) -> DataFrame:
        """world: date, all_installs, organic_installs, paid_installs, organic_revenue, daily_spend, dau."""
        ev = self.table("events").select("ts", "user_id", "event_type", "value")
        d = F.to_date("ts").alias("date")
        first_seen = ev.groupBy("user_id").agg(F.min(F.to_date("ts")).alias("date"))
        new_users = first_seen.groupBy("date").agg(F.count(F.lit(1)).alias("all_installs"))
        et = F.col("event_type")
        per_day = ev.groupBy(d).agg(
            F.count(F.when(et == "signup", 1)).alias("organic_installs"),
            F.count(F.when(et == "click", 1)).alias("paid_installs"),
            money_sum(F.when(et == "purchase", F.col("value"))).alias("organic_revenue"),
            money_sum(F.when(et == "click", F.col("value"))).alias("daily_spend"),
            F.countDistinct("user_id").alias("dau"),
        )
        return per_day.join(new_users, "date", "left").select(
            "date", F.coalesce(F.col("all_installs"), F.lit(0)).alias("all_installs"),
            "organic_installs", "paid_installs",
            F.coalesce(F.col("organic_revenue"), F.lit(0.0)).alias("organic_revenue"),
            F.coalesce(F.col("daily_spend"), F.lit(0.0)).alias("daily_spend"), "dau")

    @cached_property
    def revenue_7day(self) -> DataFrame:
        """revenue_7day: one row, revenue_7_day and rpi_7day over users' first 7 days."""
        ev = self.table("events").select("ts", "user_id", "event_type", "value")
        first_seen = ev.groupBy("user_id").agg(F.min(F.to_date("ts")).alias("first_date"))
        j = ev.join(first_seen, "user_id")
        in7 = (F.col("event_type") == "purchase") & (F.datediff(F.to_date("ts"), F.col("first_date")) <= 7)
        # one global aggregate: every user has at least one event, so the distinct count is the user count
        one = j.agg(money_sum(F.when(in7, F.col("value"))).alias("revenue_7_day"),
                    F.countDistinct("user_id").alias("users"))
        return one.select("revenue_7_day", (F.col("revenue_7_day") / F.col("users")).alias("rpi_7day"))


def load_world(spark: SparkSession, sf_dir: str) -> TestWorld:
    return TestWorld(spark, sf_dir)
