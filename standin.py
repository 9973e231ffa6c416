"""The driver's tables seen as the five sources of the arrivals star.

Each source exists twice: as a Spark frame, and as SQL text that DuckDB runs for
the oracle. A line item is an arrival, its customer's nation the origin, its
part's brand the port, its supplier's nation the state; customers stand for the
demographics, suppliers for the temperatures, parts for the airports.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators import clean
from starloom.plans.arrivals import ARRIVALS_SCHEMA, MEASURES, RACES, arrivals_sources

# Market segment -> race. Fixed values.
RACE_OF_SEGMENT = {
    "AUTOMOBILE": "Hispanic or Latino",
    "BUILDING": "White",
    "FURNITURE": "Asian",
    "HOUSEHOLD": "Black or African-American",
    "MACHINERY": "American Indian and Alaska Native",
}


@cache
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables. They never change, so their files are listed
    and their schema is read once per session."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _days(column: str):
    return F.datediff(F.col(column), F.lit("1960-01-01").cast("date")).cast("double")


def _day_text(column: str):
    return F.replace(F.col(column).cast("date").cast("string"), F.lit("-"), F.lit(""))


def raw_arrivals(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """The arrivals, or some columns of them.

    Every table joined here has a unique key and is joined from the left, so it
    changes no row count and is left out when none of its columns is wanted.
    """
    columns = list(columns or ARRIVALS_SCHEMA)
    number = F.col("l_linenumber")
    departed = (
        F.when(number == 7, None)
        .when((number == 6) & (F.col("l_linestatus") == "O"), 0.0)
        .when(F.col("l_returnflag") == "R", _days("l_shipdate") + 0.7)
        .otherwise(_days("l_shipdate"))
    )
    of_lineitem = {
        "cicid": F.col("l_orderkey").cast("double"),
        "i94mode": number.cast("double"),
        "depdate": departed,
        "i94bir": F.col("l_quantity"),
        "i94visa": (number % 3 + 1).cast("double"),
        "count": F.lit(1.0),
        "dtadfile": _day_text("l_shipdate"),
        "occup": F.when(number == 3, F.col("l_linestatus")),
        "entdepa": F.col("l_linestatus"),
        "entdepd": F.when(number != 7, F.col("l_returnflag")),
        "entdepu": F.when(F.col("l_discount") > 0.09, F.lit("U")),
        "matflag": F.when(number != 7, F.lit("M")),
        "dtaddto": _day_text("l_shipdate"),
        "gender": F.when(F.col("l_linestatus") == "O", "M").otherwise("F"),
        "insnum": F.when(F.col("l_tax") > 0.07, F.col("l_suppkey").cast("string")),
        "airline": F.col("l_returnflag"),
        "admnum": F.col("l_extendedprice"),
        "fltno": F.col("l_partkey").cast("string"),
        "visatype": F.when(F.col("l_discount") < 0.05, "B1").otherwise("B2"),
    }
    year = F.year("o_orderdate").cast("double")
    low = F.col("o_orderpriority") == "5-LOW"
    arrived = (
        F.when(low & (number == 7), None)
        .when(low & (number == 6), 0.0)
        .when(F.col("o_orderstatus") == "P", _days("o_orderdate") + 0.7)
        .otherwise(_days("o_orderdate"))
    )
    of_orders = {
        "i94yr": year,
        "i94mon": F.month("o_orderdate").cast("double"),
        "arrdate": arrived,
        "visapost": F.col("o_orderpriority"),
        "biryear": year - F.col("l_quantity"),
    }
    of_customer = {
        "i94cit": F.col("c_nationkey").cast("double"),
        "i94res": F.col("c_nationkey").cast("double"),
    }
    of_part = {"i94port": F.col("p_brand")}
    of_supplier = {"i94addr": F.when(F.col("s_suppkey") % 10 != 0, F.col("n_name"))}

    df = table(spark, sf_dir, "lineitem")
    if {*of_orders, *of_customer} & set(columns):
        orders = table(spark, sf_dir, "orders")
        if set(of_customer) & set(columns):
            # before the line items come in, which then move once, not twice
            customer = table(spark, sf_dir, "customer")
            orders = orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
        df = df.join(orders, df.l_orderkey == orders.o_orderkey, "left")
    if set(of_part) & set(columns):
        part = table(spark, sf_dir, "part")
        df = df.join(part, df.l_partkey == part.p_partkey, "left")
    if set(of_supplier) & set(columns):
        supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
        df = df.join(supplier, df.l_suppkey == supplier.s_suppkey, "left")
        df = df.join(nation, df.s_nationkey == nation.n_nationkey, "left")
    expressions = of_lineitem | of_orders | of_customer | of_part | of_supplier
    return df.select(*[expressions[c].alias(c) for c in columns])


def raw_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    states = nation.join(region, nation.n_regionkey == region.r_regionkey)
    df = customer.join(states, customer.c_nationkey == states.n_nationkey)
    key, balance = F.col("c_custkey"), F.col("c_acctbal")
    race = F.lit(None)
    for segment, name in RACE_OF_SEGMENT.items():
        race = F.when(F.col("c_mktsegment") == segment, name).otherwise(race)
    return df.select(
        F.concat(F.lit("C"), (key % 7).cast("string")).alias("City"),
        F.col("r_name").alias("State"),
        balance.alias("Median Age"),
        key.cast("double").alias("Male Population"),
        F.when(balance < 9900, (key + 10).cast("double")).alias("Female Population"),
        (key * 2 + 10).cast("int").alias("Total Population"),
        F.when(balance > -900, F.floor(balance).cast("double")).alias("Number of Veterans"),
        (balance * 2).alias("Foreign-born"),
        (key % 4 + 1).cast("double").alias("Average Household Size"),
        F.when(F.col("n_nationkey") == 9, "ZZ").otherwise(F.col("n_name")).alias("State Code"),
        race.alias("Race"),
        key.cast("int").alias("Count"),
    )


def raw_temperatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    df = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
    name = F.lower("n_name")
    key, balance = F.col("s_suppkey"), F.col("s_acctbal")
    day = F.date_add(F.lit("2015-12-31").cast("date"), (key % 3).cast("int"))
    return df.select(
        F.when(balance < -500, F.lit("1650-06-01").cast("date")).otherwise(day).alias("dt"),
        F.when(balance < 9500, balance).alias("AverageTemperature"),
        F.when(balance.between(0, 500), "  ")
        .otherwise(F.concat(F.lit("T"), (key % 5).cast("string")))
        .alias("City"),
        F.when(F.col("n_regionkey") == 4, F.concat(name, F.lit(", other")))
        .otherwise(name)
        .alias("Country"),
        F.concat(F.col("n_nationkey").cast("string"), F.lit("N")).alias("Latitude"),
        F.concat(F.col("n_regionkey").cast("string"), F.lit("E")).alias("Longitude"),
    )


def raw_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size, brand = F.col("p_partkey"), F.col("p_size"), F.col("p_brand")
    ident = F.lpad(key.cast("string"), 12, "0")
    return table(spark, sf_dir, "part").select(
        ident.alias("ident"),
        F.col("p_type").alias("type"),
        size.cast("double").alias("elevation_ft"),
        F.when(size > 20, "NA").alias("continent"),
        F.when(size > 2, "US").alias("iso_country"),
        F.concat(F.lit("US-"), size.cast("string")).alias("iso_region"),
        F.col("p_name").alias("municipality"),
        F.when(size > 10, ident).alias("gps_code"),
        F.when(~brand.isin("Brand#3", "Brand#7"), brand).alias("iata_code"),
        F.when(size > 15, ident).alias("local_code"),
        F.concat_ws(", ", size.cast("string"), key.cast("string")).alias("coordinates"),
    )


def raw_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    code = F.when(key == 5, key + 900).otherwise(key)
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit(" "), code.cast("string"), F.lit(" ")).alias("code"),
        F.col("n_name").alias("country"),
    )


RAW = {
    "arrivals": raw_arrivals,
    "demographics": raw_demographics,
    "temperatures": raw_temperatures,
    "airports": raw_airports,
    "codes": raw_codes,
}

SPECS = arrivals_sources({name: f"{name}.parquet" for name in RAW})


def sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The cleaned sources."""
    return {name: clean(raw(spark, sf_dir), SPECS[name]) for name, raw in RAW.items()}


# --------------------------------------------------------------------------
# The same in SQL. View -> (views it uses, text).

_DAYS = "cast(date_diff('day', date '1960-01-01', cast({} as date)) as double)"
_SHIP_DAYS = _DAYS.format("l_shipdate")
_ORDER_DAYS = _DAYS.format("o_orderdate")
_RACES = " ".join(f"when '{s}' then '{r}'" for s, r in RACE_OF_SEGMENT.items())
# Output column -> what is averaged over the rows of a city.
_CITY = {m.replace(" ", "") + "Avg": f'"{m}"' for m in MEASURES} | {
    name: f"""case when "Race" = '{race}' then "Count" else 0 end""" for name, race in RACES.items()
}
_DATE = "strftime(date '1960-01-01' + cast(floor({0}) as int), '%Y-%m-%d')"

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "raw_arrivals": (
        (),
        f"""
        select cast(l_orderkey as double) cicid,
               cast(year(o_orderdate) as double) i94yr,
               cast(month(o_orderdate) as double) i94mon,
               cast(c_nationkey as double) i94cit,
               cast(c_nationkey as double) i94res,
               p_brand i94port,
               case when o_orderpriority = '5-LOW' and l_linenumber = 7 then null
                    when o_orderpriority = '5-LOW' and l_linenumber = 6 then 0
                    when o_orderstatus = 'P' then {_ORDER_DAYS} + 0.7
                    else {_ORDER_DAYS} end arrdate,
               cast(l_linenumber as double) i94mode,
               case when s_suppkey % 10 <> 0 then n_name end i94addr,
               case when l_linenumber = 7 then null
                    when l_linenumber = 6 and l_linestatus = 'O' then 0
                    when l_returnflag = 'R' then {_SHIP_DAYS} + 0.7
                    else {_SHIP_DAYS} end depdate,
               l_quantity i94bir,
               cast(l_linenumber % 3 + 1 as double) i94visa,
               cast(1 as double) "count",
               strftime(l_shipdate, '%Y%m%d') dtadfile,
               o_orderpriority visapost,
               case when l_linenumber = 3 then l_linestatus end occup,
               l_linestatus entdepa,
               case when l_linenumber <> 7 then l_returnflag end entdepd,
               case when l_discount > 0.09 then 'U' end entdepu,
               case when l_linenumber <> 7 then 'M' end matflag,
               cast(year(o_orderdate) as double) - l_quantity biryear,
               strftime(l_shipdate, '%Y%m%d') dtaddto,
               case when l_linestatus = 'O' then 'M' else 'F' end gender,
               case when l_tax > 0.07 then cast(l_suppkey as varchar) end insnum,
               l_returnflag airline,
               l_extendedprice admnum,
               cast(l_partkey as varchar) fltno,
               case when l_discount < 0.05 then 'B1' else 'B2' end visatype
        from lineitem
        left join orders on l_orderkey = o_orderkey
        left join customer on o_custkey = c_custkey
        left join part on l_partkey = p_partkey
        left join supplier on l_suppkey = s_suppkey
        left join nation on s_nationkey = n_nationkey
        """,
    ),
    "arrivals": (
        ("raw_arrivals",),
        """
        select * exclude (occup, entdepu, insnum)
               replace (cast(trunc(cicid) as int) as cicid, cast(trunc(i94yr) as int) as i94yr,
                        cast(trunc(i94mon) as int) as i94mon,
                        cast(trunc(biryear) as int) as biryear,
                        cast(trunc(arrdate) as int) as arrdate,
                        cast(trunc(i94res) as int) as i94res)
        from raw_arrivals
        """,
    ),
    "raw_demographics": (
        (),
        f"""
        select 'C' || cast(c_custkey % 7 as varchar) "City", r_name "State",
               c_acctbal "Median Age",
               cast(c_custkey as double) "Male Population",
               case when c_acctbal < 9900 then cast(c_custkey + 10 as double) end
                   "Female Population",
               cast(c_custkey * 2 + 10 as int) "Total Population",
               case when c_acctbal > -900 then floor(c_acctbal) end "Number of Veterans",
               c_acctbal * 2 "Foreign-born",
               cast(c_custkey % 4 + 1 as double) "Average Household Size",
               case when n_nationkey = 9 then 'ZZ' else n_name end "State Code",
               case c_mktsegment {_RACES} end "Race",
               cast(c_custkey as int) "Count"
        from customer join nation on c_nationkey = n_nationkey
        join region on n_regionkey = r_regionkey
        """,
    ),
    "demographics": (
        ("raw_demographics",),
        """
        select * from raw_demographics
        where "Male Population" is not null and "Female Population" is not null
          and "Number of Veterans" is not null and "Foreign-born" is not null
          and "Average Household Size" is not null
        """,
    ),
    "raw_temperatures": (
        (),
        """
        select case when s_acctbal < -500 then date '1650-06-01'
                    else date '2015-12-31' + cast(s_suppkey % 3 as int) end dt,
               case when s_acctbal < 9500 then s_acctbal end "AverageTemperature",
               case when s_acctbal between 0 and 500 then '  '
                    else 'T' || cast(s_suppkey % 5 as varchar) end "City",
               case when n_regionkey = 4 then lower(n_name) || ', other'
                    else lower(n_name) end "Country",
               cast(n_nationkey as varchar) || 'N' "Latitude",
               cast(n_regionkey as varchar) || 'E' "Longitude"
        from supplier join nation on s_nationkey = n_nationkey
        """,
    ),
    "temperatures": (
        ("raw_temperatures",),
        """
        select * exclude (rn) from (
            select *, row_number() over (
                partition by dt, "City", "Country"
                order by "AverageTemperature", "Latitude", "Longitude") rn
            from raw_temperatures where "AverageTemperature" is not null) q
        where rn = 1
        """,
    ),
    "raw_airports": (
        (),
        """
        select lpad(cast(p_partkey as varchar), 12, '0') ident, p_type "type",
               cast(p_size as double) elevation_ft,
               case when p_size > 20 then 'NA' end continent,
               case when p_size > 2 then 'US' end iso_country,
               'US-' || cast(p_size as varchar) iso_region,
               p_name municipality,
               case when p_size > 10 then lpad(cast(p_partkey as varchar), 12, '0') end gps_code,
               case when p_brand not in ('Brand#3', 'Brand#7') then p_brand end iata_code,
               case when p_size > 15 then lpad(cast(p_partkey as varchar), 12, '0') end local_code,
               cast(p_size as varchar) || ', ' || cast(p_partkey as varchar) coordinates
        from part
        """,
    ),
    "airports": (
        ("raw_airports",),
        """
        select * exclude (rn) from (
            select *, row_number() over (partition by iata_code order by ident) rn
            from raw_airports) q
        where rn = 1
        """,
    ),
    "raw_codes": (
        (),
        """
        select ' ' || cast(case when n_nationkey = 5 then n_nationkey + 900
                               else n_nationkey end as varchar) || ' ' code,
               n_name country
        from nation
        """,
    ),
    "codes": (
        ("raw_codes",),
        "select cast(trim(code) as int) code, country from raw_codes",
    ),
    "fact": (
        ("arrivals",),
        f"""
        select * rename (arrdate as arrival_date, i94res as country_code,
                         i94port as arrival_port, i94addr as state_code)
        from (select * replace (
                  case when arrdate <> 0 then {_DATE.format("arrdate")} end as arrdate,
                  case when depdate <> 0 then {_DATE.format("depdate")} end as depdate)
              from arrivals) a
        """,
    ),
    "dim_date": (
        ("fact",),
        """
        select arrival_date,
               case when arrival_date is null then -1000000
                    else date_diff('day', date '1960-01-01', cast(arrival_date as date)) end id,
               cast(day(cast(arrival_date as date)) as int) "day",
               cast(week(cast(arrival_date as date)) as int) "week",
               cast(month(cast(arrival_date as date)) as int) "month",
               cast(year(cast(arrival_date as date)) as int) "year",
               cast(dayofweek(cast(arrival_date as date)) + 1 as int) "weekday"
        from (select distinct arrival_date from fact) d
        """,
    ),
    "dim_country": (
        ("arrivals", "codes", "temperatures"),
        """
        select distinct i94res country_code, country, round(temperature_avg, 6) temperature_avg
        from arrivals join codes on code = i94res
        join (select "Country" c, avg("AverageTemperature") temperature_avg
              from temperatures group by 1) t on upper(c) = country
        """,
    ),
    "dim_airport": (
        ("arrivals", "airports"),
        """
        select distinct used.i94port arrival_port, a.*
        from (select i94port from arrivals where i94mode = 1) used
        join airports a on a.iata_code = used.i94port
        union all
        select distinct used.i94port, a.*
        from (select i94port from arrivals
              where i94mode is distinct from 1
                 or i94port is null
                 or i94port not in (select iata_code from airports where iata_code is not null)) used
        left join airports a on false
        """,
    ),
    "dim_airport_unique": (
        ("dim_airport",),
        """
        select * exclude (rn) from (
            select *, row_number() over (
                partition by arrival_port order by ident nulls last) rn
            from dim_airport) q
        where rn = 1
        """,
    ),
    "city": (
        ("demographics",),
        'select "State Code", "State", "City", '
        + ", ".join(f'avg({value}) "{name}"' for name, value in _CITY.items())
        + " from demographics group by all",
    ),
    "dim_demographics": (
        ("arrivals", "city"),
        'select used.state_code, "State", '
        + ", ".join(f'round(avg("{name}"), 6) "{name}"' for name in _CITY)
        + """
        from (select distinct i94addr state_code from arrivals where i94addr is not null) used
        left join city on "State Code" = used.state_code group by all""",
    ),
}


def with_views(query: str, *names: str) -> str:
    """``query`` behind the definitions of the views it names."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in VIEWS[name][0]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    views = ",\n".join(f"{name} as ({VIEWS[name][1]})" for name in ordered)
    return f"with {views}\n{query}"
