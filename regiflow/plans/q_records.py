"""Queries on text records: ten entities as lines, parts in one read, archives."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from regiflow.operators.rules import normalize
from regiflow.plans import records as R
from regiflow.plans.catalog import register
from regiflow.schema import LAYOUTS
from regiflow.sources.archives import read_zip, write_archives
from regiflow.sources.csv import CORRUPT, read_entity, split_quarantine

_NAMES = {"Empresas": "companies", "Estabelecimentos": "establishments", "Socios": "partners", "Simples": "simples"}


def _cleaned(entity):
    def query(spark, sf):
        good, _ = split_quarantine(R.parsed(spark, sf, entity))
        return normalize(good, entity)
    query.__name__ = f"records_{_NAMES[entity]}"
    return query


for _entity, _ids in (("Empresas", "ENT1"), ("Estabelecimentos", "ENT2 all 30 columns"), ("Socios", "ENT3 all 11 columns"), ("Simples", "ENT4")):
    register(f"records_{_NAMES[_entity]}", R.normalized_sql(_entity), f"SRC1 SRC3 {_ids} STR1-5")(_cleaned(_entity))


@register("records_lookups", " UNION ALL ".join(
    f"SELECT '{e}' AS entity, codigo, descricao, source_file FROM ({R.normalized_sql(e)}) n" for e in R.LOOKUPS), "SRC1 ENT5 all six code tables")
def records_lookups(spark, sf):
    def one(entity):
        good, _ = split_quarantine(R.parsed(spark, sf, entity))
        return normalize(good, entity).select(F.lit(entity).alias("entity"), "codigo", "descricao", "source_file")
    return reduce(lambda a, b: a.unionByName(b), map(one, R.LOOKUPS))


@register("records_quarantine", " UNION ALL ".join(R.quarantine_sql(e) for e in LAYOUTS), "SRC1 SRC3 short and long records are kept as text")
def records_quarantine(spark, sf):
    def one(entity):
        _, bad = split_quarantine(R.parsed(spark, sf, entity))
        return bad.select(F.lit(entity).alias("entity"), "source_file", F.col(CORRUPT).alias("line"))
    return reduce(lambda a, b: a.unionByName(b), map(one, LAYOUTS))


@register("multi_part_union", R.normalized_sql("Empresas"), "SET5 SRC3 ten part files in one read")
def multi_part_union(spark, sf):
    folder = R.shared_folder(spark, "parts")
    # the text writer writes a string's bytes as they are: here those of ISO-8859-1
    lines = R.part_lines(spark, sf, "Empresas").withColumn("line", F.encode("line", "ISO-8859-1").cast("string"))
    lines.write.partitionBy("source_file").text(folder)
    parts = [f"{folder}/source_file=Empresas{i}.csv" for i in range(R.PARTS)]
    good, _ = split_quarantine(read_entity(spark, parts, "Empresas"))
    return normalize(good, "Empresas")


@register("archive_records", R.normalized_sql("Estabelecimentos", extension="zip"), "SRC2 SRC3 archives written and read, one per part")
def archive_records(spark, sf):
    folder = R.shared_folder(spark, "archives")
    write_archives(R.part_lines(spark, sf, "Estabelecimentos", "zip"), folder)
    # the parts have names of Spark's writer below folders with the archives' names
    raw = read_zip(spark, [folder], "Estabelecimentos", cores=spark.sparkContext.defaultParallelism).drop("member")
    good, _ = split_quarantine(raw)
    return normalize(good, "Estabelecimentos")
