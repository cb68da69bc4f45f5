"""Registry entities derived from the driver's TPC-H-like tables.

The driver ships clean TPC-H-style tables, not registry files.  Each builder
below re-expresses one registry input as a DataFrame derived from those
tables, so every query grows with the data: raw company text from
``customer``, establishments from ``orders``, partners from ``lineitem``, the
file control table and object-store inventory from ``orders``, processed-file
statistics from ``lineitem``.  Dirty values (null keys, NBSP padding, bad
numbers, no-date tokens) are made by deterministic expressions so that the
DuckDB oracle (``regiflow.plans.oracle``) can build the very same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regiflow.functions.text import parquet_name
from regiflow.schema import LAYOUTS
from regiflow.sources.tables import table

NBSP, TAB = "\u00a0", "\t"

# Fixed values of the stand-in file naming: entity prefix by ``key % 12``.
FILE_PREFIXES = [
    "Empresas", "Estabelecimentos", "Socios", "Simples", "Paises", "Municipios",
    "Qualificacoes", "Naturezas", "Cnaes", "Motivos", "Outros", "estabelecimentos",
]
# Status by ``key % 7`` (every state of the life cycle occurs).
STATUS_BY_MOD = ["pending", "downloading", "downloaded", "transforming", "transformed", "loaded", "error"]
# Company size code by market segment.
SIZE_BY_SEGMENT = {"AUTOMOBILE": "01", "BUILDING": "03", "FURNITURE": "05", "HOUSEHOLD": "00", "MACHINERY": "01"}
# Registration status code by order status.
SITUATION_BY_STATUS = {"F": "08", "O": "02", "P": "04"}
# Columns of the raw stand-in frames.
RAW_COLUMNS = {
    "Empresas": LAYOUTS["Empresas"],
    "Estabelecimentos": ["cnpj_basico", "cnpj_ordem", "cnpj_dv", "identificador_matriz_filial",
                         "nome_fantasia", "situacao_cadastral", "data_situacao_cadastral",
                         "data_inicio_atividade", "cnae_fiscal_principal", "cnae_fiscal_secundaria",
                         "uf", "municipio", "data_situacao_especial"],
}
# A control month with no object in the store (gap analysis).
STORE_MISSING_MONTH = "1993-02"
# Months at or after this one are "new" for discovery.
KNOWN_BEFORE = "1994-01"
# File keys come in months of so many; names repeat in every month.
FIRST_MONTH, FILES_PER_MONTH = "1992-01-01", 500


def _case(c: Column, mapping: dict, default=None) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    return out.otherwise(F.lit(default))


def _pick(k: Column, values: list[str]) -> Column:
    return _case(k % len(values), dict(enumerate(values)))


def _s(c: Column) -> Column:
    return c.cast("string")


def _ymd(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd")


# ---------------------------------------------------------------------------
# Raw entity text (bronze)
# ---------------------------------------------------------------------------


def raw_companies(spark: SparkSession, sf: str, *extra: Column) -> DataFrame:
    """Raw Empresas text from ``customer``."""
    k = F.col("c_custkey")
    money = F.replace(_s(F.col("c_acctbal").cast("decimal(15,2)")), F.lit("."), F.lit(","))
    return table(spark, sf, "customer").select(
        F.when(k % 101 == 0, F.lit(None).cast("string"))
        .when(k % 103 == 0, F.concat(F.lit("9"), F.lpad(_s(k), 8, "0")))
        .otherwise(_s(k)).alias("cnpj_basico"),
        F.when(k % 50 == 0, F.lit("NULL"))
        .when(k % 7 == 0, F.concat(F.lit(NBSP), F.col("c_name"), F.lit(TAB)))
        .otherwise(F.concat(F.lit("  "), F.col("c_name"), F.lit(" "))).alias("razao_social"),
        _s(F.col("c_nationkey") + 2000).alias("natureza_juridica"),
        F.lpad(_s(k % 50), 2, "0").alias("qualificacao_responsavel"),
        F.when(k % 41 == 0, F.lit("abc")).when(k % 43 == 0, F.lit("")).when(k % 59 == 0, F.lit("5d")).when(k % 61 == 0, F.lit("0x1p3"))
        .when(k % 37 == 0, F.lit("1.000,50"))
        .when(k % 29 == 0, F.concat(F.lit(" "), money, F.lit(" ")))
        .otherwise(money).alias("capital_social"),
        F.when(k % 31 == 0, F.lit("")).otherwise(_case(F.col("c_mktsegment"), SIZE_BY_SEGMENT)).alias("porte_empresa"),
        F.when(k % 97 == 0, F.lit("UNIAO")).otherwise(F.lit("")).alias("ente_federativo_responsavel"),
        *extra)


def raw_establishments(spark: SparkSession, sf: str, *extra: Column) -> DataFrame:
    """Raw Estabelecimentos text from ``orders``; urgent orders are head offices."""
    k = F.col("o_orderkey")
    d = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        _s(F.col("o_custkey")).alias("cnpj_basico"),
        F.lpad(_s(k % 10000), 4, "0").alias("cnpj_ordem"),
        F.lpad(_s(k % 97), 2, "0").alias("cnpj_dv"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("1")).otherwise(F.lit("2")).alias("identificador_matriz_filial"),
        F.col("o_orderpriority").alias("nome_fantasia"),
        _case(F.col("o_orderstatus"), SITUATION_BY_STATUS).alias("situacao_cadastral"),
        F.when(k % 13 == 0, F.lit("00000000")).otherwise(_ymd(d)).alias("data_situacao_cadastral"),
        F.when(k % 11 == 0, F.concat(F.lit(" "), F.date_format(d, "yyyy/MM/dd"), F.lit(" ")))
        .when(k % 17 == 0, F.lit("0")).when(k % 19 == 0, F.lit("20231345"))
        .otherwise(_ymd(d)).alias("data_inicio_atividade"),
        F.lpad(_s(F.col("o_custkey") % 9999999), 7, "0").alias("cnae_fiscal_principal"),
        F.when(k % 5 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(_s(k % 1000), F.lit(",A"), _s(F.col("o_custkey")), F.lit(" ;x,"), _s(k % 7))).alias("cnae_fiscal_secundaria"),
        F.when(k % 2 == 0, F.lit("SP")).otherwise(F.lit("RJ")).alias("uf"),
        _s(F.col("o_custkey") % 5000).alias("municipio"),
        F.when(k % 3 == 0, F.lit("")).otherwise(_ymd(d)).alias("data_situacao_especial"),
        *extra)


def raw_partners(spark: SparkSession, sf: str, *extra: Column) -> DataFrame:
    """Raw Socios text from ``lineitem``."""
    n = F.col("l_linenumber")
    return table(spark, sf, "lineitem").select(
        _s(F.col("l_suppkey")).alias("cnpj_basico"),
        _s(n % 3 + 1).alias("identificador_socio"),
        F.concat(F.lit("  Socio "), _s(F.col("l_partkey"))).alias("nome_socio_razao_social"),
        F.lpad(_s(F.col("l_partkey")), 11, "*").alias("cnpj_cpf_socio"),
        _s(n + 10).alias("qualificacao_socio"),
        F.when(F.col("l_orderkey") % 9 == 0, F.lit("00/00/0000")).otherwise(_ymd(F.col("l_shipdate"))).alias("data_entrada_sociedade"),
        _s(n).alias("faixa_etaria"),
        *extra)


def raw_simples(spark: SparkSession, sf: str, *extra: Column) -> DataFrame:
    """Raw Simples text: customers without debt have an option on file."""
    k = F.col("c_custkey")
    return table(spark, sf, "customer").where(F.col("c_acctbal") >= 0).select(
        _s(k).alias("cnpj_basico"),
        F.when(k % 47 == 0, F.lit("X")).when(k % 23 == 0, F.lit(" ")).when(k % 2 == 0, F.lit("S"))
        .otherwise(F.lit("N")).alias("opcao_pelo_simples"),
        F.when(k % 2 == 0, F.concat(F.lit("2007"), F.lpad(_s(k % 12 + 1), 2, "0"), F.lit("01")))
        .otherwise(F.lit("00000000")).alias("data_opcao_simples"),
        F.when(k % 3 == 0, F.lit("20231345")).otherwise(F.lit("0")).alias("data_exclusao_simples"),
        F.when(k % 7 == 0, F.lit("S")).otherwise(F.lit("N")).alias("opcao_mei"),
        F.when(k % 7 == 0, F.lit("20090701")).otherwise(F.lit("")).alias("data_opcao_mei"),
        F.lit("00000000").alias("data_exclusao_mei"),
        *extra)


def lookup_naturezas(spark: SparkSession, sf: str) -> DataFrame:
    """Code table (codigo, descricao) from ``nation``: a bounded domain."""
    return table(spark, sf, "nation").select(
        _s(F.col("n_nationkey") + 2000).alias("codigo"), F.col("n_name").alias("descricao"),
        F.col("n_regionkey"))


def lookup_regions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")


# ---------------------------------------------------------------------------
# File control table, discovery listing, object store, processed stats
# ---------------------------------------------------------------------------


def _is_root(k: Column) -> Column:
    return k % 53 == 0


def _file_name(k: Column) -> Column:
    """The registry ships the same names every month; only root files are named apart."""
    n = F.when(_is_root(k), k).otherwise(k % FILES_PER_MONTH)
    ext = F.when(n % 10 == 9, F.lit(".ZIP")).otherwise(F.lit(".zip"))
    return F.concat(_pick(n, FILE_PREFIXES), _s(n), ext)


def _year_month(k: Column) -> Column:
    month = F.add_months(F.lit(FIRST_MONTH).cast("date"), F.floor(k / FILES_PER_MONTH).cast("int"))
    return F.when(_is_root(k), F.lit("BASE")).otherwise(F.date_format(month, "yyyy-MM"))


def _size(price: Column) -> Column:
    return (price.cast("decimal(15,2)") * 100).cast("bigint")


def control(spark: SparkSession, sf: str) -> DataFrame:
    """Current state of every known file (one row per order)."""
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    status = _pick(k, STATUS_BY_MOD)
    base = table(spark, sf, "orders").select(
        k.alias("file_id"), _year_month(k).alias("year_month"), _file_name(k).alias("file_name"),
        F.when(k % 19 == 0, F.lit(None).cast("bigint")).otherwise(_size(F.col("o_totalprice"))).alias("file_size_bytes"),
        F.md5(_s(F.col("o_custkey"))).alias("etag"), status.alias("status"), d.alias("discovered_at"),
        F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("order_status"))
    st, size = F.col("status"), F.col("file_size_bytes")
    fetched = ~st.isin("pending", "downloading")
    return base.select(
        "file_id", "year_month", "file_name", "file_size_bytes", "etag",
        F.when(~fetched | (F.col("file_id") % 17 == 0), F.lit(None).cast("string"))
        .otherwise(F.sha2(_s(F.col("file_id")), 256)).alias("local_hash"),
        F.when(st == "pending", F.lit(None).cast("bigint"))
        .when(st == "downloading", size - F.col("file_id") % 1000)
        .when(F.col("file_id") % 23 == 0, size + 5).otherwise(size).alias("local_size_bytes"),
        F.when(st == "pending", F.lit(0.0)).when(st == "downloading", (F.col("file_id") % 100).cast("double"))
        .when(st == "error", F.lit(0.0)).otherwise(F.lit(100.0)).alias("download_progress"),
        "discovered_at",
        F.when(fetched & (st != "error"), F.col("discovered_at") + F.expr("INTERVAL 1 DAY")).alias("synced_at"),
        "status",
        F.when(st == "error", F.concat(F.lit("download failed: "), F.col("file_name"))).alias("error_message"),
        "priority", "order_status",
    )


def remote_listing(spark: SparkSession, sf: str) -> DataFrame:
    """What discovery lists remotely: every file, etag changed for some."""
    k = F.col("o_orderkey")
    etag = F.when(k % 31 == 0, F.md5(_s(F.col("o_custkey") + 1))).otherwise(F.md5(_s(F.col("o_custkey"))))
    return table(spark, sf, "orders").select(
        _year_month(k).alias("year_month"), _file_name(k).alias("file_name"),
        _size(F.col("o_totalprice")).alias("size"), etag.alias("etag"))


def known_control(spark: SparkSession, sf: str) -> DataFrame:
    """Control rows already registered before a discovery run."""
    c = control(spark, sf)
    old = (c.year_month == "BASE") | (c.year_month < KNOWN_BEFORE)
    return c.where(old & (c.priority != "5-LOW"))


def store_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """Object-store listing: (key, size_bytes, last_modified, etag, content_hash)."""
    c = control(spark, sf)
    k, st, pr, os = F.col("file_id"), F.col("status"), F.col("priority"), F.col("order_status")
    ym, name, at = F.col("year_month"), F.col("file_name"), F.col("discovered_at")
    here = ym != STORE_MISSING_MONTH
    none = F.lit(None).cast("string")

    def obj(when, key, size, moment, etag, digest=none):
        return F.when(when, F.struct(key.alias("key"), size.cast("bigint").alias("size_bytes"), moment.alias("last_modified"),
                                     etag.alias("etag"), digest.alias("content_hash")))

    recorded = F.coalesce(F.col("local_size_bytes"), F.col("file_size_bytes"), F.lit(0))
    fetched = ~st.isin("pending", "downloading") & (pr != "5-LOW") | (st == "downloading") & (pr == "1-URGENT")
    digest = F.when(os != "P", F.when(k % 29 == 0, F.sha2(_s(k + 1), 256)).otherwise(F.sha2(_s(k), 256)))
    objects = F.array(
        obj(here & fetched, F.concat(F.lit("raw/"), ym, F.lit("/"), name), recorded + F.when(k % 13 == 0, 1).otherwise(0),
            at + F.expr("INTERVAL 2 DAYS"), F.md5(_s(k)), digest),
        obj(here & st.isin("transformed", "loaded") & (pr != "4-NOT SPECIFIED"), F.concat(F.lit("processed/"), ym, F.lit("/"), parquet_name(name)),
            F.floor(F.coalesce(F.col("file_size_bytes"), F.lit(0)) / 4), at + F.expr("INTERVAL 3 DAYS"), F.md5(_s(k + 7))),
        obj(os == "P", F.concat(F.lit("raw/"), F.date_format(F.add_months(F.to_date(at), 240), "yyyy-MM"), F.lit("/orphan"), _s(k), F.lit(".zip")),
            k * 10, at, F.md5(_s(k))),
        obj(here & (ym != "BASE") & (pr == "2-HIGH") & (os == "F"), F.concat(ym, F.lit("/"), name), k * 3, at, F.md5(_s(k))),
        obj((ym == "BASE") & (pr == "3-MEDIUM"), F.concat(F.lit("readme"), _s(k), F.lit(".txt")), k, at, F.md5(_s(k))))
    # one scan: every file's possible objects, exploded
    return c.select(F.explode(F.filter(objects, lambda x: x.isNotNull())).alias("o")).select("o.*")


def processed_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Per processed Parquet file: rows and bytes (footer statistics stand-in)."""
    k = F.col("l_orderkey")
    return (
        table(spark, sf, "lineitem").groupBy("l_orderkey")
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum(F.col("l_linenumber") * 1000 + 4096).alias("size_bytes"),
             F.bool_or(F.col("l_returnflag") == "R").alias("returned"))
        .where("returned")
        .select(_year_month(k).alias("year_month"), parquet_name(_file_name(k)).alias("parquet_file"), "row_count", "size_bytes")
    )


def control_events(spark: SparkSession, sf: str) -> DataFrame:
    """Append-only state log: events as (file, status, event_time, seq)."""
    return table(spark, sf, "events").select(
        F.concat(F.lit("File"), _s(F.col("user_id")), F.lit(".zip")).alias("file_name"),
        F.col("event_type").alias("status"), F.col("ts").alias("event_time"),
        F.col("event_id").alias("seq"), F.col("value"))
