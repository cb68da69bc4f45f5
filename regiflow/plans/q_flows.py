"""Queries on flows between stores: listings, publishing, logs, streams, profiles kept per file."""

from __future__ import annotations

from pyspark.sql import functions as F

from regiflow.functions.text import truncate
from regiflow.operators import column_states
from regiflow.operators.rules import clean_na
from regiflow.plans import oracle as O
from regiflow.plans import records as R
from regiflow.plans import standins as S
from regiflow.plans.catalog import register
from regiflow.schema import ERROR_MESSAGE_CHARS, LAYOUTS
from regiflow.sinks import control_log, publish
from regiflow.sinks.files import names, rename
from regiflow.sources.archives import write_archives
from regiflow.sources.listing import month_folders, webdav_listing
from regiflow.sources.tables import table
from regiflow.streaming.archives import ingest_archives

_REMOTE = f"({O.REMOTE_LISTING})"


def _saved_listings(spark, sf):
    """The remote listing as multistatus XML, a reply per month, below the shared folder."""
    remote = S.remote_listing(spark, sf)
    entry = F.concat(F.lit("<D:response><D:href>/dados/"), "year_month", F.lit("/"), F.replace("file_name", F.lit("s"), F.lit("&#115;")),
                     F.lit("</D:href><D:propstat><D:prop><D:resourcetype/><D:getcontentlength>"), F.col("size").cast("string"),
                     F.lit("</D:getcontentlength><D:getetag>&quot;"), "etag", F.lit("&quot;</D:getetag></D:prop></D:propstat></D:response>"))
    head = ('<?xml version="1.0"?><D:multistatus xmlns:D="DAV:"><D:response><D:href>/dados/', "/</D:href><D:propstat><D:prop><D:resourcetype>"
            "<D:collection/></D:resourcetype></D:prop></D:propstat></D:response><!-- <D:response><D:href>/dados/old.zip</D:href></D:response> -->")
    months = remote.select("year_month").distinct()
    lines = remote.select("year_month", F.lit(1).alias("o"), entry.alias("value")).unionByName(
        months.select("year_month", F.lit(0).alias("o"), F.concat(F.lit(head[0]), "year_month", F.lit(head[1])).alias("value"))).unionByName(
        months.select("year_month", F.lit(2).alias("o"), F.lit("</D:multistatus>").alias("value")))
    folder = R.shared_folder(spark, "listings")
    (lines.repartition("year_month").sortWithinPartitions("year_month", "o").select(F.col("year_month").alias("month"), "value")
     .write.partitionBy("month").text(folder))
    return folder


@register("webdav_entries", f"""
SELECT '/dados/' || year_month || '/' || file_name AS href, file_name AS name, false AS is_dir, size, etag FROM {_REMOTE} r""",
          "SRC7 multistatus XML: prefixes, entities, comments, own folders")
def webdav_entries(spark, sf):
    return webdav_listing(spark, _saved_listings(spark, sf))


@register("webdav_months", f"SELECT DISTINCT year_month FROM {_REMOTE} r WHERE year_month <> 'BASE'", "SRC7 SET4 FLT6 month folders of listings")
def webdav_months(spark, sf):
    # a listing of the root: the months are its folders
    roots = webdav_listing(spark, _saved_listings(spark, sf)).select(
        F.split_part("href", F.lit("/"), F.lit(3)).alias("name"), F.lit(True).alias("is_dir"))
    return month_folders(roots)


@register("publish_files", f"""
SELECT 'source_file=' || source_file AS folder, lines, true AS copied, true AS hashed, 0::BIGINT AS copied_again FROM (
  SELECT {R.part_sql('Simples', 'zip')} AS source_file, count(*) AS lines FROM ({R.raw_sql('Simples')}) r GROUP BY 1) p""",
          "SNK11 files copied once, with size and hash")
def publish_files(spark, sf):
    source, target = R.shared_folder(spark, "to-publish"), R.shared_folder(spark, "published")
    lines = R.part_lines(spark, sf, "Simples", "zip")
    write_archives(lines, source)
    first = publish.publish(spark, source, target, "part-*")
    again = publish.publish(spark, source, target, "part-*").count()
    n = lines.groupBy(F.concat(F.lit("source_file="), "source_file").alias("folder")).agg(F.count(F.lit(1)).alias("lines"))
    done = first.select(F.substring_index("key", "/", 1).alias("folder"), (F.col("size_bytes") > 0).alias("copied"), (F.length("content_hash") == 64).alias("hashed"))
    return n.join(done, "folder").withColumn("copied_again", F.lit(again).cast("long"))


@register("log_compaction", f"""
SELECT file_name, status, event_time, seq, value FROM (
  SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY event_time DESC, seq DESC) AS rn
  FROM ({O.CONTROL_EVENTS}) e) t WHERE rn = 1""", "WIN2 CTL8 snapshot and tail of the event log")
def log_compaction(spark, sf):
    root, events = R.shared_folder(spark, "log"), S.control_events(spark, sf)
    for k in range(2):
        control_log.append(spark, root, events.where(F.col("seq") % 3 == k))
    control_log.compact(spark, root, ["file_name"])
    control_log.append(spark, root, events.where(F.col("seq") % 3 == 2))
    return control_log.state(spark, root, ["file_name"])


@register("stream_archives", R.normalized_sql("Socios", extension="zip"), "INC1 SRC2 archives taken up once by a stream")
def stream_archives(spark, sf):
    folder, out = R.shared_folder(spark, "incoming"), R.shared_folder(spark, "streamed")
    write_archives(R.part_lines(spark, sf, "Socios", "zip"), folder)
    # a folder and a file name of Spark's writer stand for each archive
    for f in names(spark, folder):
        for part in names(spark, f"{folder}/{f}"):
            if part.startswith("part-"):
                rename(spark, f"{folder}/{f}/{part}", f"{folder}/{f.removeprefix('source_file=')}")
    offsets = R.shared_folder(spark, "offsets")
    for _ in range(2):                                           # the second run finds nothing new
        ingest_archives(spark, folder, "Socios", out, offsets, "2025-06")
    return spark.read.parquet(out).select(*LAYOUTS["Socios"], "source_file")


_MONTH = "'2025-0' || (_k % 3 + 1)"


def _kept_states(spark, sf):
    """States of the part files of establishments, kept as a table; a part belongs to the month of its records."""
    df = clean_na(R.records(spark, sf, "Estabelecimentos")).withColumn("year_month", F.concat(F.lit("2025-0"), F.col("_k") % 3 + 1)).withColumn(
        "source_file", F.concat(F.lit("Estabelecimentos"), F.pmod("_k", F.lit(R.PARTS))))
    folder = R.shared_folder(spark, "states")
    column_states.file_states(df, ("year_month", "source_file"), LAYOUTS["Estabelecimentos"]).write.parquet(folder)
    return spark.read.parquet(folder)


def _clean_sql():
    return f"SELECT {', '.join(f'{O.na(c)} AS {c}' for c in LAYOUTS['Estabelecimentos'])}, {_MONTH} AS year_month FROM ({R.raw_sql('Estabelecimentos')}) r"


def _states_sql():
    src = f"({_clean_sql()})"
    one = lambda c: (f"SELECT year_month, '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count, min({c}) AS min_value, "  # noqa: E731
                     f"max({c}) AS max_value, count(DISTINCT {c}) AS n FROM {src} s GROUP BY year_month")
    # beyond what a sketch holds exactly its count is an estimate, which SQL cannot repeat
    return (f"SELECT year_month, column_name, row_count, null_count, min_value, max_value, CASE WHEN n <= 2000 THEN n END AS unique_count, "
            f"CASE WHEN row_count = 0 THEN 'N/A' ELSE printf('%.1f%%', round(100.0 * null_count / row_count, 1)) END AS null_pct "
            f"FROM ({' UNION ALL '.join(map(one, LAYOUTS['Estabelecimentos']))}) p")


@register("profile_states", _states_sql(), "AGG8 AGG9 DQ5 profiles of a month merged from its files' states, 30 columns")
def profile_states(spark, sf):
    p = column_states.merged(_kept_states(spark, sf), ("year_month",))
    return p.select("year_month", "column_name", "row_count", "null_count", "min_value", "max_value",
                    F.when(F.col("unique_count") <= 2000, F.col("unique_count")).alias("unique_count"), "null_pct")


@register("profile_issue_totals", f"""
SELECT year_month, CAST(null_keys > 0 AS INTEGER) AS issues, CAST(odd_keys > 0 AS INTEGER) + empty_columns AS warnings, null_keys, odd_keys, empty_columns
FROM (SELECT year_month, count(*) - count(cnpj_basico) AS null_keys, count(*) FILTER (WHERE length(cnpj_basico) <> 8) AS odd_keys,
  {' + '.join(f'(count({c}) = 0)::BIGINT' for c in LAYOUTS['Estabelecimentos'])} AS empty_columns
  FROM ({_clean_sql()}) s GROUP BY year_month) t""", "DQ6 DQ7 issue and warning totals of a month")
def profile_issue_totals(spark, sf):
    return column_states.issue_totals(column_states.merged(_kept_states(spark, sf), ("year_month",)), ("year_month",))


@register("error_messages_long", f"""
SELECT event_id, substr(repeat(props || ' ', 40), 1, {ERROR_MESSAGE_CHARS}) AS error_message,
  length(repeat(props || ' ', 40)) > {ERROR_MESSAGE_CHARS} AS was_cut FROM events""", "STR12 messages beyond the limit are cut")
def error_messages_long(spark, sf):
    message = F.repeat(F.concat("props", F.lit(" ")), F.lit(40))
    return table(spark, sf, "events").select("event_id", truncate(message, ERROR_MESSAGE_CHARS).alias("error_message"),
                                             (F.length(message) > ERROR_MESSAGE_CHARS).alias("was_cut"))
