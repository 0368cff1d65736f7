"""Registrar tables derived from the driver's star-schema test data.

There are no registrar tables to test with, so each one is derived from the
TPC-H-like test tables by one plain SELECT.  The same texts run in Spark (with
the test tables passed as DataFrame arguments) and, as CTEs, in DuckDB for the
oracle, so both engines see identical inputs.  The only dialect difference is
the naive timestamp type name.

``ord`` and ``sec2`` are helpers; ``sec_rec`` carries ``mtg_no`` only to derive
from (staging drops it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registrar_feeds.session import shuffles_freed

# Test tables read from the driver's data directory.
BASE_TABLES = ("nation", "part", "supplier", "customer", "orders", "lineitem")

# Derivation texts, in dependency order.  {name} refers to a base table or an
# earlier derived table; {TS} is the naive timestamp type of the dialect.
DERIVED_SQL: dict[str, str] = {
    "ord": """select o_orderkey mtg_no, o_custkey, o_orderstatus, o_orderpriority,
        cast(o_orderdate as date) d, cast(year(o_orderdate) as string) yr,
        case when month(o_orderdate)<=5 then 'RC' when month(o_orderdate)<=8 then 'RB' else 'RA' end sess
        from {orders}""",
    "crs_rec": """select 'C'||lpad(cast(p_partkey as string),7,'0') crs_no, 'UG18' cat,
        'D'||cast(p_partkey%25 as string) dept,
        case p_partkey%10 when 0 then 'PRDV' when 1 then 'PARA' else 'UNDG' end prog,
        p_name title1, p_brand title2, p_type title3 from {part}""",
    "jenzccd_rec": """select 'C'||lpad(cast(p_partkey as string),7,'0')||' (UG18)' course_code,
        case when p_partkey%50=0 then null else p_name end title,
        'D'||cast(p_partkey%30 as string) dept_code from {part}""",
    "jenzdpt_rec": "select 'D'||cast(n_nationkey as string) dept_code, n_name descr from {nation}",
    "dept_table": "select 'D'||cast(n_nationkey as string) dept, n_name txt from {nation}",
    "bldg_table": "select 'B'||cast(n_nationkey as string) bldg, n_name txt from {nation}",
    "sess_table": """select distinct sess,
        case sess when 'RA' then 'Fall' when 'RB' then 'Summer' else 'Spring' end txt from {ord}""",
    "mtg_rec": """select mtg_no, yr, sess, 'B'||cast(o_custkey%30 as string) bldg,
        case when o_custkey%17=0 then null else 'R'||cast(o_custkey%400 as string) end room,
        case when o_custkey%13=0 then null when o_orderstatus='F' then 'M-W-F--' else '-T-R---' end as days,
        800.0+100*(mtg_no%9) beg_tm, 850.0+100*(mtg_no%9) end_tm, d beg_date,
        cast(d + interval 120 day as date) end_date
        from {ord} where mtg_no%19<>0
        union all
        select mtg_no, yr, sess, 'B'||cast(o_custkey%30 as string),
        case when o_custkey%17=0 then null else 'R'||cast(o_custkey%400 as string) end,
        '-----S-', 900.0, 1150.0, d, cast(d + interval 120 day as date)
        from {ord} where mtg_no%11=0 and mtg_no%19<>0""",
    "sec_rec": """select 'C'||lpad(cast(l_partkey as string),7,'0') crs_no,
        '0'||cast(l_linenumber as string) sec_no, 'UG18' cat, yr, sess,
        case when l_linenumber%2=0 then 'S1' else 'S2' end subsess, l_suppkey fac_id,
        cast(l_linenumber%5 as decimal(4,2)) hrs,
        case when l_returnflag='R' then 'X' else 'O' end stat,
        cast(l_shipdate as date) stat_date, d beg_date,
        cast(d + interval 120 day as date) end_date, mtg_no
        from {lineitem} join {ord} on l_orderkey=mtg_no""",
    "secmtg_rec": "select crs_no, sec_no, cat, yr, sess, mtg_no from {sec_rec}",
    "sec2": "select s.*, c.prog from {sec_rec} s join {crs_rec} c on s.crs_no=c.crs_no and s.cat=c.cat",
    "jenzcrs_rec": """select crs_no||' ('||cat||')' course_code, sec_no sec,
        sess||' '||yr||' '||prog term_code,
        yr||';'||sess||';'||crs_no||';'||sec_no||';'||cat||';'||prog coursekey,
        cast(hrs as string) hrs from {sec2} where stat<>'X'""",
    "jenzsch_rec": "select course_code, sec, term_code from {jenzcrs_rec} where sec='01'",
    "jenztrm_rec": """select term_code, min(beg_date) start_date, max(end_date) end_date
        from (select sess||' '||yr||' '||prog term_code, beg_date, end_date from {sec2}) q
        group by term_code""",
    "id_rec": """select s_suppkey id, s_name lastname, 'F'||cast(s_suppkey%97 as string) firstname,
        '' middlename from {supplier}
        union all
        select 100000+c_custkey, c_name, 'F'||cast(c_custkey%97 as string), 'M' from {customer}""",
    "jenzcst_rec": """select 100000+c_custkey host_id,
        case c_custkey%14 when 0 then 'FAC' when 1 then 'AMA' when 2 then 'PGR' when 3 then 'ALM'
        when 4 then 'GLL' when 5 then 'STF' when 6 then null else 'STU' end status_code
        from {customer}
        union all
        select 100000+c_custkey, 'STF' from {customer} where c_custkey%4=0""",
    "jenzprs_rec": """select 100000+c_custkey host_id, 'u'||cast(c_custkey as string) host_username,
        'u'||cast(c_custkey as string)||'@x.edu' e_mail from {customer} where c_custkey%20<>0""",
    "job_rec": """select 100000+o_custkey id, 1+mtg_no%4 title_rank,
        case when mtg_no%3=0 then null when mtg_no%3=1 then d else date '2030-01-01' end end_date,
        case when mtg_no%29=0 then null when mtg_no%31=0 then 'x' else o_orderpriority end job_title,
        case mtg_no%5 when 0 then 'VEN' when 1 then 'GRD' when 2 then null else 'FVT' end hrpay
        from {ord}""",
    "prog_enr_rec": """select 100000+c_custkey id,
        case c_custkey%3 when 0 then 'GOOD' when 1 then 'GRAD' else 'WD' end acst,
        case when c_custkey%8=0 then 'Y' else 'N' end tle from {customer}""",
    "addree_rec": """select 100000+c_custkey prim_id, 'N' style, 'Nick'||cast(c_custkey%50 as string) alt_name
        from {customer} where c_custkey%5=0""",
    "role_rec": """select 100000+c_custkey id,
        case when c_custkey%2=0 then 'PREFF' else 'OTHER' end role,
        case when c_custkey%3=0 then null else date '1998-01-01' end end_date
        from {customer} where c_custkey%7=0""",
    "jenzcrp_rec": """select s.crs_no||' ('||s.cat||')' course_code, s.sec_no sec,
        s.sess||' '||s.yr||' '||s.prog term_code, cast(100000+o.o_custkey as string) host_id,
        'STU' status_code from {sec2} s join {ord} o on s.mtg_no=o.mtg_no where s.stat<>'X'""",
    "audit_sec_rec": """select crs_no,sec_no,cat,yr,sess,fac_id,beg_date,end_date,'O' stat,stat_date,
        stat_date schd_upd_date, cast(stat_date as {TS}) audit_timestamp from {sec_rec} where stat='X'
        union all
        select crs_no,sec_no,cat,yr,sess,fac_id,beg_date,end_date,'X',stat_date,stat_date,
        cast(stat_date as {TS}) from {sec_rec} where stat='X'""",
}

HELPERS = ("ord", "sec2")

# Line items with the programmes of their course: every row, once for each course
# it matches (``nth``, from 1; null without one).  The sections are derived from
# them with these two columns, so that plain numbers are dealt for both joins.
PROGRAMMES_SQL = """select l.*, c.prog, c.nth from {lineitem} l left join
    (select crs_no, cat, prog, row_number() over (partition by crs_no, cat order by prog) nth from {crs_rec}) c
    on 'C'||lpad(cast(l.l_partkey as string),7,'0')=c.crs_no and 'UG18'=c.cat"""


def _refs(text: str) -> list[str]:
    import re
    return [m for m in re.findall(r"\{(\w+)\}", text) if m != "TS"]


def derive_tables(spark: SparkSession, sf_dir: str, sections_dir: str | None = None) -> dict[str, DataFrame]:
    """Lazy DataFrames of all registrar tables derived from ``sf_dir``.

    Each frame repeats the joins it derives from.  With ``sections_dir`` those of
    the sections run once, now, into Parquet files there, and the tables derived
    from them read the files: for queries that use several of these tables.
    """
    env: dict[str, DataFrame] = {
        t: spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet") for t in BASE_TABLES
    }
    for name, text in DERIVED_SQL.items():
        if name not in env:
            env[name] = spark.sql(text.replace("{TS}", "timestamp_ntz"), **{r: env[r] for r in _refs(text)})
        if name == "sec_rec" and sections_dir:
            env["sec_rec"], env["sec2"] = _kept_sections(spark, env, sections_dir)
    env["sec_rec"] = env["sec_rec"].drop("mtg_no")
    return {k: v for k, v in env.items() if k not in BASE_TABLES and k not in HELPERS}


def _kept_sections(spark: SparkSession, env: dict[str, DataFrame], path: str) -> tuple[DataFrame, DataFrame]:
    """``sec_rec`` and ``sec2``, read from one file set written here.

    Of the ship time only the day is used, so only that is shuffled.  The files are
    sorted by day: their rows, and those shuffled for the tables read from them,
    compress better beside others of the same term.
    """
    text = DERIVED_SQL["sec_rec"].replace("select ", "select prog, nth, ", 1)
    source = {r: env[r] for r in _refs(PROGRAMMES_SQL)}
    source["lineitem"] = source["lineitem"].withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    lines = spark.sql(PROGRAMMES_SQL, **source)
    sections = spark.sql(text, **{**{r: env[r] for r in _refs(text)}, "lineitem": lines}).sortWithinPartitions("beg_date")
    with shuffles_freed(spark):
        sections.write.option("compression", "zstd").parquet(path)
    kept = spark.read.schema(sections.schema).parquet(path)
    names = env["sec_rec"].columns
    return (kept.where(F.coalesce(F.col("nth"), F.lit(1)) == 1).select(*names),
            kept.where(F.col("nth").isNotNull()).select(*names, "prog"))


def duckdb_ctes() -> str:
    """The derivations as a DuckDB ``WITH`` prefix (no trailing comma).

    ``sec_rec`` keeps its ``mtg_no`` helper (as ``sec_rec_full``) for the tables
    derived from it; the ``sec_rec`` the queries see drops it, as in Spark.
    """
    parts = []
    for name, text in DERIVED_SQL.items():
        body = text.replace("{TS}", "timestamp")
        for r in set(_refs(text)):
            body = body.replace("{" + r + "}", "sec_rec_full" if r == "sec_rec" else r)
        if name == "sec_rec":
            parts.append(f"sec_rec_full AS ({body})")
            parts.append("sec_rec AS (select * exclude (mtg_no) from sec_rec_full)")
        else:
            parts.append(f"{name} AS ({body})")
    return "WITH " + ",\n".join(parts)
