"""One query per operator. Each takes the session and the folder of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.incidents import incidents
from cinderlake.functions.draws import with_permutation
from cinderlake.functions.sql import register_functions
from cinderlake.functions.text import clean_str, first_letter_acronym
from cinderlake.operators.columns import (
    bind_columns,
    cast_columns,
    fill_nulls,
    load_by_position,
    map_strings,
    normalize_names,
    require_columns,
)
from cinderlake.operators.joins import Dimension, lookup_dimensions
from cinderlake.operators.keyed import (
    assign_surrogate_keys,
    distinct_dimension,
    first_per_key,
    insert_if_absent,
)
from cinderlake.operators.quality import (
    constraint_report,
    drop_colliding_rows,
    find_repeated_values,
    max_values,
)
from cinderlake.operators.sideways import repeats_side_by_side
from cinderlake.plans import daily, marts
from cinderlake.plans.growth import ROW, grow_snapshot, new_incidents
from cinderlake.plans.medallion import load_incidents, load_latest
from cinderlake.schemas import UNIQUE_FIELDS, struct
from cinderlake.sources.bucketed import BucketedTable
from cinderlake.sources.incident_source import FORMAT, register_incidents
from cinderlake.sources.rejects import read_checked
from cinderlake.sources.snapshots import (
    latest_of_many,
    latest_snapshot,
    next_snapshot_name,
    read_latest,
    read_snapshot,
    write_snapshot,
)
from cinderlake.sources.synthetic import synthetic_incidents
from cinderlake.sources.warehouse import Warehouse, append_rows, create_table
from cinderlake.streaming.keyed import insert_stream
from cinderlake.streaming.snapshots import load_new_snapshots
from cinderlake.workspace import materialize, new_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dollars(column: str):
    """A two-decimal double as an exact decimal, so sums do not depend on their order."""
    return F.col(column).cast("decimal(18,2)")


# Marts


@query
def dim_date_full(spark, sf_dir):
    return marts.calendar_with_counts(table(spark, sf_dir, "orders"), date="o_orderdate")


@query
def incidents_by_weekday(spark, sf_dir):
    return marts.incidents_by_weekday(table(spark, sf_dir, "orders"), date="o_orderdate")


@query
def avg_by_month(spark, sf_dir):
    return marts.average_alarms_by_month(
        table(spark, sf_dir, "lineitem"), alarms="l_quantity", date="l_shipdate"
    )


@query
def total_by_quarter(spark, sf_dir):
    totals = marts.property_loss_by_quarter(
        table(spark, sf_dir, "orders"), loss=dollars("o_totalprice"), date="o_orderdate"
    )
    return totals.withColumn("total_property_loss", F.col("total_property_loss").cast("double"))


@query
def count_avg_by_year(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return marts.response_by_year(
        lines, ("l_partkey", "l_suppkey", "l_linenumber"), date="l_shipdate"
    )


@query
def rate_by_weekend(spark, sf_dir):
    flags = table(spark, sf_dir, "lineitem").select(
        "l_shipdate",
        (F.col("l_returnflag") == "R").cast("bigint").alias("returned"),
        (F.col("l_linestatus") == "F").cast("bigint").alias("finished"),
    )
    return marts.fatality_rate_by_weekend(flags, ("returned", "finished"), date="l_shipdate")


@query
def top5_days_avg(spark, sf_dir):
    return marts.top_days_by_alarms(
        table(spark, sf_dir, "lineitem"), alarms="l_quantity", date="l_shipdate"
    )


@query
def events_by_weekday_by_day(spark, sf_dir):
    return marts.incidents_by_weekday(table(spark, sf_dir, "events"), date="ts", by_day=True)


@query
def latest_rows(spark, sf_dir):
    return marts.latest_rows(table(spark, sf_dir, "orders"), ("o_orderdate", "o_orderkey"))


@query
def row_count(spark, sf_dir):
    return marts.row_count(table(spark, sf_dir, "lineitem"))


# Columns and text


@query
def clean_and_acronym(spark, sf_dir):
    padded = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat(F.lit(" \t"), F.col("p_name"), F.lit(" of "), F.col("p_type"), F.lit("\n")).alias("name"),
        F.lower("p_brand").alias("brand"),
    )
    cleaned = map_strings(padded, clean_str)
    return cleaned.withColumn("acronym", first_letter_acronym(F.col("name")))


@query
def fill_missing(spark, sf_dir):
    rich = table(spark, sf_dir, "customer").where("c_acctbal > 5000")
    orders = table(spark, sf_dir, "orders")
    joined = orders.join(rich, orders.o_custkey == rich.c_custkey, "left").select(
        "o_orderkey", "c_acctbal", "c_nationkey", "c_mktsegment"
    )
    return fill_nulls(joined, ["c_acctbal", "c_nationkey"])


@query
def normalize_rename(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    titled = orders.select([F.col(c).cast("string").alias(c.replace("_", " ").title()) for c in orders.columns])
    back = bind_columns(normalize_names(titled), list(reversed(orders.columns)))
    typed = cast_columns(back.select(*orders.columns), orders.schema)
    renamed = struct("order long\ncustomer long\nstatus string\nprice double\nplaced timestamp\npriority string")
    return require_columns(load_by_position(typed, renamed), ["order", "placed"])


# Keys


@query
def distinct_pairs(spark, sf_dir):
    return distinct_dimension(table(spark, sf_dir, "part"), ["p_name", "p_brand"])


@query
def first_row_per_key(spark, sf_dir):
    return first_per_key(table(spark, sf_dir, "part"), ["p_name"], ["p_partkey"])


@query
def insert_if_absent_fact(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    held = lines.where("l_shipdate < TIMESTAMP_NTZ'1997-01-01'")
    return insert_if_absent(held, lines, ["l_orderkey", "l_linenumber"])


@query
def null_key_insert(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    keyed = orders.select(
        F.expr("CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END").alias("customer"), "o_orderkey", "o_totalprice"
    )
    held = table(spark, sf_dir, "customer").where("c_nationkey = 5").select(F.col("c_custkey").alias("customer"))
    return insert_if_absent(held, keyed, ["customer"], ["o_orderkey"])


@query
def surrogate_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey", "o_totalprice")
    return assign_surrogate_keys(orders, ["o_orderdate", "o_orderkey"], "order_sk", after=1000)


@query
def lookup_keys(spark, sf_dir):
    return _lookup(spark, sf_dir)


@query
def lookup_keys_hot(spark, sf_dir):
    """The same lookups as if the dimensions were too large to broadcast."""
    return _lookup(spark, sf_dir, max_broadcast_bytes=0)


def _lookup(spark, sf_dir, **options):
    customers = table(spark, sf_dir, "customer").where("c_nationkey <> 7")
    customers = customers.select(
        F.col("c_custkey").alias("o_custkey"), (F.col("c_custkey") + 500).alias("customer_sk")
    )
    priorities = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.min("o_orderkey").alias("priority_sk"))
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.expr("CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_custkey END").alias("o_custkey"),
        "o_orderpriority",
    )
    found = lookup_dimensions(
        orders,
        [
            Dimension(customers, "o_custkey", "customer_sk"),
            Dimension(priorities, "o_orderpriority", "priority_sk"),
        ],
        **options,
    )
    return found.select("o_orderkey", "customer_sk", "priority_sk")


# Quality


@query
def drop_colliding(spark, sf_dir):
    return drop_colliding_rows(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_extendedprice"])


@query
def repeated_values(spark, sf_dir):
    return find_repeated_values(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey"])


@query
def field_maxima(spark, sf_dir):
    return max_values(table(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey", "o_totalprice"])


@query
def constraints(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "l_tax", F.expr("CASE WHEN l_tax = 0 THEN NULL ELSE l_tax END")
    )
    return constraint_report(
        lines,
        unique=[["l_orderkey", "l_linenumber"], ["l_orderkey", "l_partkey", "l_suppkey"]],
        not_null=["l_orderkey", "l_tax"],
    )


# Sources and sinks

_OLD = datetime(2024, 1, 6)
_NEW = datetime(2024, 1, 7, 12, 30)


def _round_trip(spark, df, **options):
    """Write two snapshots, the first with all rows twice; read back the one found to be latest."""
    root = new_folder(spark, "snapshots")
    first = next_snapshot_name(None, _OLD)
    write_snapshot(df.unionByName(df), root, first)
    write_snapshot(df, root, next_snapshot_name(first, _NEW))
    latest = latest_snapshot(spark, root)
    back = read_snapshot(spark, f"{root}/{latest}", df.schema, **options)
    return back.withColumn("snapshot", F.lit(latest))


@query
def csv_round_trip(spark, sf_dir):
    return _round_trip(spark, table(spark, sf_dir, "orders"))


@query
def csv_round_trip_text(spark, sf_dir):
    return _round_trip(spark, table(spark, sf_dir, "documents"), na_tokens=(), multi_line=True)


@query
def append_load(spark, sf_dir):
    """Two appends by position into a table that was emptied before."""
    columns = struct("account long\nname string\nnation int\nbalance double\nsegment string")
    path = new_folder(spark, "accounts")
    customers = table(spark, sf_dir, "customer")
    suppliers = table(spark, sf_dir, "supplier").withColumn("s_segment", F.lit("supplier"))
    append_rows(customers, path, columns)
    create_table(spark, path, columns)
    append_rows(customers, path, columns)
    append_rows(suppliers, path, columns)
    return spark.read.schema(columns).parquet(path)


@query
def latest_of_nothing(spark, sf_dir):
    """The empty frame of a folder without snapshots, beside all orders."""
    root = new_folder(spark, "snapshots").rsplit("/", 1)[0]
    nothing = read_latest(spark, root).select("id", "city", "incident_date")
    orders = table(spark, sf_dir, "orders")
    return orders.join(nothing, orders.o_orderkey == nothing.id, "left")


# Whole jobs


def _warehouse(spark) -> Warehouse:
    warehouse = Warehouse(spark, new_folder(spark, "warehouse"))
    warehouse.reset()
    return warehouse


def _two_snapshots(spark, sf_dir):
    """The incidents before 1998, and all of them."""
    everything = incidents(spark, sf_dir)
    return everything.where("incident_date < TIMESTAMP_NTZ'1998-01-01'"), everything


def _star(warehouse: Warehouse) -> DataFrame:
    """The fact with its dimensions' values."""
    return (
        warehouse.read("fact_fire_department_injuries")
        .join(warehouse.read("dim_battalion"), "dim_battalion_sk", "left")
        .join(warehouse.read("dim_district"), "dim_district_sk", "left")
    )


@query
def medallion_load(spark, sf_dir):
    """Snapshots through CSV and all layers: a part first, then everything, then again."""
    root = new_folder(spark, "snapshots")
    warehouse = _warehouse(spark)
    name = None
    for snapshot, moment in zip(_two_snapshots(spark, sf_dir), (_OLD, _NEW)):
        name = next_snapshot_name(name, moment)
        write_snapshot(snapshot, root, name)
        load_latest(warehouse, root)
    load_latest(warehouse, root)
    return _star(warehouse)


@query
def medallion_counts(spark, sf_dir):
    """Rows each table gains from a part, from everything, and from everything again."""
    warehouse = _warehouse(spark)
    part, everything = _two_snapshots(spark, sf_dir)
    gained = [load_incidents(warehouse, s) for s in (part, everything, everything)]
    rows = [(n, t, c) for n, load in enumerate(gained, 1) for t, c in load.items()]
    return spark.createDataFrame(rows, "load_number int, table_name string, rows_gained bigint")


@query
def medallion_raw(spark, sf_dir):
    root = new_folder(spark, "snapshots")
    write_snapshot(incidents(spark, sf_dir), root, next_snapshot_name(None, _OLD))
    warehouse = _warehouse(spark)
    load_latest(warehouse, root, load_id="first")
    return warehouse.read("raw_fact_fire_department")


@query
def medallion_marts(spark, sf_dir):
    """A mart over a loaded fact, with the calendar table of the warehouse."""
    warehouse = _warehouse(spark)
    load_incidents(warehouse, incidents(spark, sf_dir))
    fact = warehouse.read("fact_fire_department_injuries")
    return marts.response_by_year(fact, calendar=warehouse.read("dim_date"))


@query
def streaming_load(spark, sf_dir):
    """The two snapshots as a stream of files."""
    root, warehouse = new_folder(spark, "snapshots"), _warehouse(spark)
    checkpoint = new_folder(spark, "stream")
    for snapshot, moment in zip(_two_snapshots(spark, sf_dir), (_OLD, _NEW)):
        write_snapshot(snapshot, root, next_snapshot_name(None, moment))
        load_new_snapshots(warehouse, root, checkpoint).awaitTermination()
    return _star(warehouse)


@query
def streaming_order(spark, sf_dir):
    """Two snapshots that differ for ids and cities they share, both there before the stream starts.

    The older one comes last by name.
    """
    root, warehouse = new_folder(spark, "snapshots"), _warehouse(spark)
    part, everything = _two_snapshots(spark, sf_dir)
    changed = part.withColumns(
        {
            "incident_number": F.col("incident_number") + 1_000_000_000,
            "city": F.concat("city", F.lit("and more")),
        }
    )
    write_snapshot(changed, root, "z_older_1.csv")
    write_snapshot(everything, root, "a_newer_2.csv")
    load_new_snapshots(warehouse, root, new_folder(spark, "stream")).awaitTermination()
    return _star(warehouse)


START, END = datetime(2020, 1, 1), datetime(2024, 1, 6, 12)


def _draw_rows(spark, sf_dir):
    """One incident is drawn for every order."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias(ROW))


@query
def synthetic_rows(spark, sf_dir):
    rows = _draw_rows(spark, sf_dir)
    maxima = max_values(incidents(spark, sf_dir), UNIQUE_FIELDS).first().asDict()
    return synthetic_incidents(rows, ROW, rows.count(), maxima, START, END, seed=7)


@query
def snapshot_growth(spark, sf_dir):
    """A snapshot and what survives of the incidents drawn for it."""
    snapshot, rows = incidents(spark, sf_dir), _draw_rows(spark, sf_dir)
    added = new_incidents(snapshot, rows, ROW, rows.count(), START, END, seed=7)
    return snapshot.unionByName(added)


@query
def grown_snapshot(spark, sf_dir):
    """A snapshot file and its successor as it was written, after the check for repeats."""
    root = new_folder(spark, "snapshots")
    write_snapshot(incidents(spark, sf_dir), root, next_snapshot_name(None, _OLD))
    drawn = table(spark, sf_dir, "orders").count()
    name = grow_snapshot(spark, root, drawn, START, END, seed=7)
    return read_snapshot(spark, f"{root}/{name}", na_tokens=())


# Faults, upkeep and large targets


@query
def repeats_laid_side_by_side(spark, sf_dir):
    """Orders with several lines beside prices and clerks' flags that occur more than once."""
    return repeats_side_by_side(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey", "l_returnflag", "l_extendedprice"]
    )


_ORDER_LINE = struct(
    "o_orderkey long\no_custkey long\no_orderstatus string\no_totalprice double\n"
    "o_orderdate timestamp\no_orderpriority string"
)


def _faulty_orders(spark, sf_dir):
    """All orders as a snapshot in which some lines are torn and some values do not fit."""
    key = F.col("o_orderkey")
    values = table(spark, sf_dir, "orders").select(
        F.when(key % 101 == 0, "").otherwise(key.cast("string")).alias("o_orderkey"),
        F.when(key % 7 == 0, F.concat(F.lit("c"), "o_custkey")).otherwise(F.col("o_custkey").cast("string")),
        "o_orderstatus",
        F.when(key % 5 == 0, "NA").when(key % 21 == 0, "much").otherwise(dollars("o_totalprice").cast("string")),
        F.when(key % 17 == 0, "1996-02-30 00:00:00").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")),
        "o_orderpriority",
        key.alias("_key"),
    )
    whole = F.concat_ws(",", *[F.col(f"`{c}`") for c in values.columns[:-1]])
    line = F.when(F.col("_key") % 11 == 0, F.concat(whole, F.lit(",more")))
    line = line.when(F.col("_key") % 13 == 0, F.substring_index(whole, ",", 3)).otherwise(whole)
    path = new_folder(spark, "snapshots") + "/faulty_orders.csv"
    # A line is one value of a table whose only column is named by the header.
    header = ",".join(f.name.upper() for f in _ORDER_LINE.fields)
    values.select(line.alias(header)).write.csv(path, header=True, sep="\x01")
    return read_checked(spark, path, _ORDER_LINE, required=["o_orderkey"])


@query
def checked_rows(spark, sf_dir):
    """What is good of a snapshot with faults."""
    return _faulty_orders(spark, sf_dir).rows


@query
def rejected_rows(spark, sf_dir):
    """Every fault of the same snapshot, and how many lines are rejected."""
    checked = _faulty_orders(spark, sf_dir)
    return checked.rejects.drop("file").withColumn("rejected_lines", F.lit(checked.rejected_lines).cast("long"))


_LINE_MEASURES = marts.Measures(
    alarms="l_quantity",
    loss="l_extendedprice",
    personnel=("l_partkey", "l_suppkey", "l_linenumber"),
    fatalities=("returned", "finished"),
)


def _measured_lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_shipdate",
        "l_quantity",
        dollars("l_extendedprice").alias("l_extendedprice"),
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_returnflag",
        (F.col("l_returnflag") == "R").cast("bigint").alias("returned"),
        (F.col("l_linestatus") == "F").cast("bigint").alias("finished"),
    )


@query
def marts_in_one_scan(spark, sf_dir):
    lines = _measured_lines(spark, sf_dir)
    found = marts.marts_in_one_scan(lines, _LINE_MEASURES, date="l_shipdate")
    return found.withColumn("total_property_loss", F.col("total_property_loss").cast("double"))


def _added_up(spark, sf_dir):
    """Sums by day of three loads, the lines by return flag, each written by itself."""
    lines = _measured_lines(spark, sf_dir)
    path = new_folder(spark, "sums")
    for flag in ("A", "N", "R"):
        gained = daily.sums_by_day(lines.where(F.col("l_returnflag") == flag), _LINE_MEASURES, "l_shipdate")
        gained.write.parquet(f"{path}/load_id={flag}")
    return spark.read.schema(gained.schema).parquet(path)


@query
def marts_after_loads(spark, sf_dir):
    """The same marts, put together from the sums of three loads."""
    found = daily.grouped_marts(_added_up(spark, sf_dir))
    return found.withColumn("total_property_loss", F.col("total_property_loss").cast("double"))


@query
def top_days_after_loads(spark, sf_dir):
    return daily.top_days_by_alarms(_added_up(spark, sf_dir))


@query
def bucketed_insert(spark, sf_dir):
    """Lines into a bucketed table: the older ones, then all, then all again."""
    lines = table(spark, sf_dir, "lineitem")
    path = new_folder(spark, "bucketed")
    name = "lines_" + path.rsplit("-", 1)[1].split("/")[0]
    target = BucketedTable(spark, name, path, lines.schema, ["l_orderkey", "l_linenumber"], 16)
    target.create()
    target.insert(lines.where("l_shipdate < TIMESTAMP_NTZ'1997-01-01'"))
    gained = [target.insert(lines) for _ in range(2)]
    return target.read().withColumn("gained_again", F.lit(gained[1]).cast("long"))


@query
def keys_without_collisions(spark, sf_dir):
    """A number above the highest key for every order, each of them once."""
    orders = assign_surrogate_keys(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], "n", after=-1)
    orders = materialize(orders, "numbered")
    count, highest = orders.agg(F.count("*"), F.max("o_orderkey")).first()
    drawn = with_permutation(orders, "n", count, 7, ["id"])
    return drawn.select("o_orderkey", (F.col("id") + F.lit(highest + 1)).alias("id"))


@query
def streaming_insert(spark, sf_dir):
    """The first order of each customer out of a stream that is stopped and started again."""
    orders = table(spark, sf_dir, "orders")
    keyed = orders.select(
        F.expr("CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END").alias("customer"),
        "o_orderkey", "o_orderdate",
    )
    held = table(spark, sf_dir, "customer").where("c_nationkey = 5").select(F.col("c_custkey").alias("customer"))
    top = new_folder(spark, "stream")
    late = F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz")
    for part in (keyed.where(late), keyed.where(~late)):
        part.write.mode("append").parquet(f"{top}/in")
        stream = spark.readStream.schema(keyed.schema).parquet(f"{top}/in")
        insert_stream(
            stream, f"{top}/out", f"{top}/checkpoint", ["customer"], ["o_orderkey"], target=held
        ).awaitTermination()
    return spark.read.schema(keyed.schema).parquet(f"{top}/out")


@query
def sql_functions(spark, sf_dir):
    """Cleaning and acronyms as SQL, and a calendar made by SQL for the days of the orders."""
    register_functions(spark)
    table(spark, sf_dir, "part").createOrReplaceTempView("checked_part")
    table(spark, sf_dir, "orders").createOrReplaceTempView("checked_orders")
    return spark.sql(
        """
        SELECT clean_text(concat(' ', p_name, char(9))) AS what, city_acronym(p_name) AS short,
               count(*) AS things
        FROM checked_part GROUP BY ALL
        UNION ALL
        SELECT day_name, quarter_name, count(o_orderkey)
        FROM calendar(DATE'1992-01-01', 2557) LEFT JOIN checked_orders ON o_orderdate = date_actual
        GROUP BY ALL
        """
    )


@query
def incident_source(spark, sf_dir):
    """An incident for every order out of the data source, with keys above those of the incidents."""
    register_incidents(spark)
    maxima = max_values(incidents(spark, sf_dir), UNIQUE_FIELDS).first().asDict()
    reader = spark.read.format(FORMAT).options(**{f"max_{f}": top for f, top in maxima.items()})
    reader = reader.option("rows", table(spark, sf_dir, "orders").count()).option("seed", 7)
    return reader.options(start=START.isoformat(), end=END.isoformat()).load()


@query
def latest_of_many_snapshots(spark, sf_dir):
    """The orders of every year as a snapshot of their own; the latest as listed in tasks, read again."""
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    root = new_folder(spark, "snapshots")
    for (year,) in orders.select("year").distinct().orderBy("year").collect():
        write_snapshot(orders.where(F.col("year") == year), root, f"{year}/orders_of_{year}.csv")
    latest = latest_of_many(spark, root)
    return read_snapshot(spark, f"{root}/{latest}", orders.schema).withColumn("snapshot", F.lit(latest))
