"""CSV, ZIP, XML listing and file inventory sources."""

import os

from pyspark.sql import functions as F

from regiflow.operators.rules import normalize
from regiflow.sources import archives, listing
from regiflow.sources.csv import read_by_type, read_entity, sample_per_file, split_quarantine
from tests.conftest import SF_SMALL, rows
from tests.fixtures import DIRTY_LINES, csv_lines, write_csv, write_zip


def test_csv_entity_read_quarantine(spark, tmp_path):
    lines = csv_lines(spark, SF_SMALL)
    write_csv(str(tmp_path / "raw" / "Empresas0.csv"), lines[:100])
    write_csv(str(tmp_path / "raw" / "Empresas1.csv"), lines[100:] + DIRTY_LINES)
    write_csv(str(tmp_path / "raw" / "Simples.csv"), ["1;S;20070101;0;N;;00000000"])
    df = read_by_type(spark, str(tmp_path / "raw"), "Empresas")
    good, bad = split_quarantine(df)
    # whole input accounted for: good + quarantined = lines written
    assert good.count() + bad.count() == len(lines) + len(DIRTY_LINES)
    assert sorted(r["_corrupt_record"] for r in bad.collect()) == sorted([DIRTY_LINES[-1], DIRTY_LINES[-2]])
    silver = {r["cnpj_basico"]: r for r in normalize(good.drop("source_file"), "Empresas").collect()}
    assert silver["123456789"]["razao_social"] == "NOVE DIGITOS"
    assert silver["00000077"]["razao_social"] == "NBSP E TAB"
    assert silver["00000077"]["capital_social"] == -5.0
    assert silver["00000078"]["razao_social"] is None and silver["00000078"]["capital_social"] is None
    assert silver["00000079"]["razao_social"] == 'ASPAS "DUPLAS"; E PONTO'
    assert silver["00000080"]["razao_social"] == "AÇÃO ÉPICA"
    assert None in silver  # the null key stays null
    files = {r["source_file"] for r in df.select("source_file").distinct().collect()}
    assert files == {"Empresas0.csv", "Empresas1.csv"}


def test_csv_multiline_option(spark, tmp_path):
    p = str(tmp_path / "Empresas0.csv")
    write_csv(p, ['5;"multi\nline";1;1;1,0;1;1'])
    assert split_quarantine(read_entity(spark, p, "Empresas"))[1].count() == 2
    good = read_entity(spark, p, "Empresas", multi_line=True)
    assert rows(good.select("razao_social")) == [{"razao_social": "multi\nline"}]


def test_sample_per_file(spark, tmp_path):
    lines = csv_lines(spark, SF_SMALL)
    write_csv(str(tmp_path / "Empresas0.csv"), lines[:50])
    write_csv(str(tmp_path / "Empresas1.csv"), lines[50:60])
    s = sample_per_file(read_entity(spark, str(tmp_path), "Empresas"), 20)
    got = {r["source_file"]: r["count"] for r in s.groupBy("source_file").count().collect()}
    assert got == {"Empresas0.csv": 20, "Empresas1.csv": 10}


def test_zip_source(spark, tmp_path):
    lines = csv_lines(spark, SF_SMALL)
    d = tmp_path / "zips"
    write_zip(str(d / "Empresas0.zip"), {"K3241.K03200Y0.D50614.EMPRECSV": lines[:80]})
    write_zip(str(d / "Empresas1.zip"), {"first.csv": lines[80:] + DIRTY_LINES, "second.csv": ["999;X;1;1;1;1;1"]})
    write_zip(str(d / "Empresas2.zip"), {})
    (d / "Empresas3.zip").write_bytes(b"not a zip")
    df = archives.read_zip(spark, str(d / "*.zip"), "Empresas")
    good = df.where(F.col("_corrupt_record").isNull())
    assert good.count() == len(lines) + len(DIRTY_LINES) - 2
    bad = sorted(r["_corrupt_record"] for r in df.where(F.col("_corrupt_record").isNotNull()).collect())
    assert len(bad) == 3 and "not a zip archive: Empresas3.zip" in bad
    # only the first member is read
    assert good.where(F.col("cnpj_basico") == "999").count() == 0
    # same result for the folder, and with the lines spread before parsing
    alt = archives.read_zip(spark, str(d), "Empresas", cores=8)
    assert alt.where(F.col("_corrupt_record").isNull()).count() == good.count()
    inv = {r["file_name"]: r["status"] for r in archives.archive_inventory(spark, str(d)).collect()}
    assert inv == {"Empresas0.zip": "ok", "Empresas1.zip": "multiple_members", "Empresas2.zip": "empty",
                   "Empresas3.zip": "corrupt"}


DAV = """<?xml version="1.0" encoding="utf-8"?>
<d:multistatus xmlns:d="DAV:">
<d:response><d:href>/dados/</d:href><d:propstat><d:prop><d:resourcetype><d:collection/></d:resourcetype></d:prop></d:propstat></d:response>
<d:response><d:href>/dados/2025-06/</d:href><d:propstat><d:prop><d:resourcetype><d:collection/></d:resourcetype><d:getetag>"d1"</d:getetag></d:prop></d:propstat></d:response>
<d:response><d:href>/dados/temp/</d:href><d:propstat><d:prop><d:resourcetype><d:collection/></d:resourcetype></d:prop></d:propstat></d:response>
<d:response><d:href>/dados/x.zip</d:href><d:propstat><d:prop><d:resourcetype/><d:getcontentlength>1234</d:getcontentlength><d:getetag>"e1"</d:getetag></d:prop></d:propstat></d:response>
<d:response><d:href>/dados/x.tar.gz</d:href><d:propstat><d:prop><d:resourcetype/><d:getcontentlength>10</d:getcontentlength><d:getetag>"e2"</d:getetag></d:prop></d:propstat></d:response>
<d:response><d:href>/dados/readme.txt</d:href><d:propstat><d:prop><d:resourcetype/><d:getcontentlength>5</d:getcontentlength><d:getetag>"e3"</d:getetag></d:prop></d:propstat></d:response>
</d:multistatus>"""


def test_webdav_listing(spark, tmp_path):
    p = tmp_path / "root.xml"
    p.write_text(DAV)
    lst = listing.webdav_listing(spark, str(p))
    got = {r["name"]: (r["is_dir"], r["size"], r["etag"]) for r in lst.collect()}
    assert got == {"2025-06": (True, None, "d1"), "temp": (True, None, None), "x.zip": (False, 1234, "e1"),
                   "x.tar.gz": (False, 10, "e2"), "readme.txt": (False, 5, "e3")}
    assert rows(listing.month_folders(lst)) == [{"year_month": "2025-06"}]
    assert sorted(r["name"] for r in listing.archive_files(lst).collect()) == ["x.tar.gz", "x.zip"]


def test_webdav_listings_of_one_kind_and_other_prefixes(spark, tmp_path):
    dav = DAV.replace("<d:", "<D0:").replace("</d:", "</D0:").replace("xmlns:d=", "xmlns:D0=")
    (tmp_path / "other.xml").write_text(dav)
    assert listing.webdav_listing(spark, str(tmp_path / "other.xml")).count() == 5
    one = ("<?xml version='1.0'?><multistatus xmlns='DAV:'><response><href>/dav/2025-06/</href><propstat><prop><resourcetype><collection/>"
           "</resourcetype></prop></propstat></response>{}</multistatus>")
    file = "<response><href>/dav/2025-06/a&amp;b.zip</href><propstat><prop><getcontentlength>7</getcontentlength><resourcetype/></prop></propstat></response>"
    (tmp_path / "files.xml").write_text(one.format(file))
    (tmp_path / "none.xml").write_text(one.format(""))
    got = [tuple(r) for r in listing.webdav_listing(spark, str(tmp_path / "files.xml")).collect()]
    assert got == [("/dav/2025-06/a&b.zip", "a&b.zip", False, 7, None)]
    assert listing.webdav_listing(spark, str(tmp_path / "none.xml")).collect() == []
    # several listings at once: each drops its own folder only
    assert listing.webdav_listing(spark, str(tmp_path / "*.xml")).count() == 6


def test_inventory_and_hash(spark, tmp_path):
    import hashlib
    root = tmp_path / "store"
    for key, data in {"raw/2025-06/a.zip": b"abc", "processed/2025-06/a.parquet": b"x" * 70000, "a.zip": b"z"}.items():
        os.makedirs(os.path.dirname(root / key), exist_ok=True)
        (root / key).write_bytes(data)
    inv = {r["key"]: r["size_bytes"] for r in listing.inventory(spark, str(root)).collect()}
    assert inv == {"raw/2025-06/a.zip": 3, "processed/2025-06/a.parquet": 70000, "a.zip": 1}
    h = {r["key"]: r["content_hash"] for r in listing.with_content_hash(spark, str(root)).collect()}
    assert h["raw/2025-06/a.zip"] == hashlib.sha256(b"abc").hexdigest()
    st = listing.hash_files_streaming(listing.inventory(spark, str(root)))
    h2 = {r["path"].rsplit("/", 1)[-1] + str(len(r["path"])): r["content_hash"] for r in st.collect()}
    assert hashlib.sha256(b"x" * 70000).hexdigest() in h2.values()


def test_parquet_row_counts(spark, tmp_path):
    out = str(tmp_path / "p")
    spark.range(100).repartition(3).write.parquet(out)
    c = listing.parquet_row_counts(spark, out)
    assert c.agg(F.sum("row_count")).first()[0] == 100 and c.count() == 3


def test_read_by_type_routes_mixed_case_names(spark, tmp_path):
    lines = csv_lines(spark, SF_SMALL)
    write_csv(str(tmp_path / "Empresas0.csv"), lines[:10])
    write_csv(str(tmp_path / "empresas1.CSV"), lines[10:15])
    write_csv(str(tmp_path / "Socios0.csv"), ["1;2;X;123;10;20230101;;;;;1"])
    df = read_by_type(spark, str(tmp_path), "Empresas")
    assert df.count() == 15
    assert {r[0] for r in df.select("source_file").distinct().collect()} == {"Empresas0.csv", "empresas1.CSV"}


def test_spread_archive_rows(spark, tmp_path):
    lines = csv_lines(spark, SF_SMALL)
    d = tmp_path / "zips"
    write_zip(str(d / "Empresas0.zip"), {"a.csv": lines[:90]})
    write_zip(str(d / "Empresas1.zip"), {"b.csv": lines[90:]})
    paths = [str(d / "Empresas0.zip"), str(d / "Empresas1.zip")]
    raw = archives.read_zip(spark, paths, "Empresas").drop("member")
    assert raw.select("source_file", F.spark_partition_id()).distinct().count() == 2      # an archive is one task's work
    spread = archives.spread_archive_rows(raw, len(paths), cores=8)
    placed = spread.select("source_file", "cnpj_basico", "razao_social", F.spark_partition_id().alias("p"))
    first = sorted(map(tuple, placed.collect()), key=str)
    assert len(first) == len(lines)                              # nothing lost or doubled
    assert {r[0] for r in first} == {"Empresas0.zip", "Empresas1.zip"}
    assert len({r[3] for r in first}) > 2                        # more tasks than archives
    # a recomputed partition sends every row to the same place
    assert sorted(map(tuple, placed.collect()), key=str) == first
    # one archive on one core: nothing to spread, no shuffle
    assert archives.spread_archive_rows(raw, 1, cores=1) is raw


def test_records_of_any_length_and_damage(spark, tmp_path):
    """A record of 3 MB, short and long records, quoted line breaks, stored members, damage."""
    import zipfile
    huge = f'9000001;{"PK" * 1_500_000};1;1;1,0;01;'
    lines = [f"{i};N{i};1;1;1,0;01;" for i in range(2000)]
    write_zip(str(tmp_path / "Empresas0.zip"), {"a.csv": [*lines[:1000], huge, DIRTY_LINES[-1], *lines[1000:]]})
    with zipfile.ZipFile(str(tmp_path / "Empresas1.zip"), "w", zipfile.ZIP_STORED) as z:
        z.writestr("s.csv", "\r\n".join([*lines[:10], '11;"two\nlines";1;1;1,0;01;', "", "  "]))
    whole = (tmp_path / "Empresas0.zip").read_bytes()
    (tmp_path / "Empresas2.zip").write_bytes(whole[:len(whole) // 2])
    broken = bytearray(whole)
    broken[len(whole) // 3] ^= 0x40
    (tmp_path / "Empresas3.zip").write_bytes(bytes(broken))
    df = archives.read_zip(spark, str(tmp_path), "Empresas", multi_line=True)
    got = df.groupBy("source_file", F.col("_corrupt_record").isNull().alias("ok"), (F.col("member") == "").alias("bad")).count().collect()
    n = {(r["source_file"], r["ok"], r["bad"]): r["count"] for r in got}
    assert n[("Empresas0.zip", True, False)] == 2001 and n[("Empresas0.zip", False, False)] == 1
    assert n[("Empresas1.zip", True, False)] == 11
    assert n[("Empresas2.zip", False, True)] == 1 and n[("Empresas3.zip", False, True)] == 1
    long = df.where("source_file = 'Empresas0.zip' and cnpj_basico = '9000001'").select(F.length("razao_social")).first()[0]
    assert long == 3_000_000
    assert df.where("source_file = 'Empresas1.zip' and cnpj_basico = '11'").first()["razao_social"] == "two\nlines"
    # many splits of a file come back in order
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        again = archives.read_zip(spark, str(tmp_path / "Empresas0.zip"), "Empresas")
        assert again.where(F.col("_corrupt_record").isNull()).count() == 2001
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_archives_through_a_path_that_python_cannot_open(spark, tmp_path):
    write_zip(str(tmp_path / "in" / "Empresas0.zip"), {"a.csv": csv_lines(spark, SF_SMALL)[:30]})
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.reg.link./in", f"file://{tmp_path}/in")
    far = archives.read_zip(spark, "viewfs://reg/in", "Empresas")
    near = archives.read_zip(spark, str(tmp_path / "in"), "Empresas")
    assert sorted(map(str, far.collect())) == sorted(map(str, near.collect())) and far.count() == 30
    hashed = listing.hash_files_streaming(listing.inventory(spark, "viewfs://reg/in")).collect()
    import hashlib
    assert [r.content_hash for r in hashed] == [hashlib.sha256((tmp_path / "in" / "Empresas0.zip").read_bytes()).hexdigest()]


def test_hash_of_awkward_files(spark, tmp_path):
    import hashlib
    files = {"a": b"PKPK", "b": b"xPK", "c": b"\xef\xbb\xbfBOM PK", "d": b"P" * 10, "e": b"PK", "f": os.urandom(300_000)}
    for k, v in files.items():
        (tmp_path / k).write_bytes(v)
    got = {r.path[-1]: r.content_hash for r in listing.hash_files_streaming(listing.inventory(spark, str(tmp_path))).collect()}
    assert got == {k: hashlib.sha256(v).hexdigest() for k, v in files.items()}


def test_written_archives_are_archives(spark, tmp_path):
    import glob
    import zipfile
    lines = spark.range(5000).select(F.concat(F.lit("Empresas"), F.col("id") % 3, F.lit(".zip")).alias("source_file"),
                                     F.concat_ws(";", F.col("id"), F.lit("PKé PK"), F.lit("1;1;1,0;01;")).alias("line"))
    archives.write_archives(lines, str(tmp_path / "out"))
    files = glob.glob(f"{tmp_path}/out/source_file=*/part-*")
    assert len(files) == 3
    with zipfile.ZipFile(files[0]) as z:
        assert z.testzip() is None and len(z.read(z.namelist()[0]).splitlines()) in (1666, 1667)
    back = archives.parsed(archives.archive_lines(spark, files), "Empresas")
    assert back.where(F.col("_corrupt_record").isNull()).count() == 5000
    assert back.select("source_file").distinct().count() == 3 and back.first()["razao_social"] == "PKé PK"


def test_archive_rows_are_cut_once_however_the_bytes_come():
    data = b"PKPaPKKPPK" * 50 + b"P"
    for size in (1, 2, 3, 7, 1000):
        cut = archives._Cut()
        rows = [r for i in range(0, len(data), size) for r in cut.feed(data[i:i + size])]
        assert [*rows, cut.close()] == data.split(b"PK")


def test_a_batch_of_lines_is_deflated_at_once(monkeypatch):
    import pyarrow as pa
    calls, feed = [], archives._Zip.feed
    monkeypatch.setattr(archives._Zip, "feed", lambda self, plain: calls.append(len(plain)) or feed(self, plain))
    names, lines = ["a.zip"] * 3 + ["b.zip"] * 2, ["1", "é", "", "4", "5"]
    out = list(archives._packed([pa.RecordBatch.from_arrays([pa.array(names), pa.array(lines)], ["source_file", "line"])] * 1))
    assert calls == [5, 4] and {r["source_file"] for b in out for r in b.to_pylist()} == {"a.zip", "b.zip"}
