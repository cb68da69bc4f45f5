"""Copying publish, streamed archives, compacted control log, multistatus XML."""

import hashlib
import os
import time

import pytest
from pyspark.sql import functions as F

from regiflow.operators.control import latest_state
from regiflow.plans import standins as S
from regiflow.sinks import control_log, publish, transaction
from regiflow.sources import listing
from regiflow.streaming.archives import ingest_archives
from tests.conftest import SF_SMALL
from tests.fixtures import DIRTY_LINES, csv_lines, write_zip


def test_publish_copies_once_and_resumes(spark, tmp_path):
    src, dst = tmp_path / "src", str(tmp_path / "dst")
    files = {"raw/2025-06/a.zip": os.urandom(200_000), "raw/2025-06/b.zip": b"xPKyPK", "p/PK": b"PK", "p/text": b"no separator\n" * 10}
    for k, v in files.items():
        (src / k).parent.mkdir(parents=True, exist_ok=True)
        (src / k).write_bytes(v)
    first = {r["key"]: (r["size_bytes"], r["content_hash"]) for r in publish.publish(spark, str(src), dst).collect()}
    assert first == {k: (len(v), hashlib.sha256(v).hexdigest()) for k, v in files.items()}
    assert all((tmp_path / "dst" / k).read_bytes() == v for k, v in files.items())
    assert publish.publish(spark, str(src), dst).count() == 0                      # nothing is copied again
    (tmp_path / "dst" / "raw/2025-06/a.zip").write_bytes(files["raw/2025-06/a.zip"][:1000])      # half there
    (src / "raw/2025-06/c.zip").write_bytes(b"new")
    again = sorted(r["key"] for r in publish.publish(spark, str(src), dst).collect())
    assert again == ["raw/2025-06/a.zip", "raw/2025-06/c.zip"]
    assert (tmp_path / "dst" / "raw/2025-06/a.zip").read_bytes() == files["raw/2025-06/a.zip"]
    assert not [f for _, _, names in os.walk(dst) for f in names if f.endswith(".part")]


def test_publish_removes_what_a_failed_task_left(tmp_path):
    w = publish._Writer({"path": str(tmp_path)})
    with pytest.raises(OSError):
        w.write(iter([{"key": "a/x", "size": 10, "bytes": b"123"}]))
    left = tmp_path / "a" / f"y.{w.attempt}.0.part"
    left.write_bytes(b"half")
    w.abort([publish.Copied([("a/z", 1, "h")]), None])
    assert not left.exists() and len(list((tmp_path / publish.RECORDS).iterdir())) == 1


def test_streamed_archives(spark, tmp_path):
    raw, out, state = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "ckpt")
    lines = csv_lines(spark, SF_SMALL)
    write_zip(str(raw / "Empresas0.zip"), {"a.csv": lines[:40]})
    write_zip(str(raw / "Empresas1.zip"), {"a.csv": lines[40:60] + DIRTY_LINES})
    (raw / "Empresas2.zip").write_bytes(b"no archive")
    run = lambda: ingest_archives(spark, str(raw), "Empresas", out, state, "2025-06")
    counts = lambda: {r["source_file"]: r["count"] for r in spark.read.parquet(out).groupBy("source_file").count().collect()}
    assert run() == 1
    assert counts() == {"Empresas0.zip": 40, "Empresas1.zip": 20 + len(DIRTY_LINES) - 2}
    assert spark.read.parquet(f"{out}_quarantine").where("source_file = 'Empresas2.zip'").count() == 1
    assert run() == 0 and counts()["Empresas0.zip"] == 40                       # a rerun adds nothing
    time.sleep(0.05)
    write_zip(str(raw / "Empresas0.zip"), {"a.csv": lines[:25]})                   # changed: its rows are replaced
    write_zip(str(raw / "Empresas3.zip"), {"a.csv": lines[60:70]})
    assert run() == 1
    assert counts() == {"Empresas0.zip": 25, "Empresas1.zip": 20 + len(DIRTY_LINES) - 2, "Empresas3.zip": 10}


def test_compacted_log_has_the_same_state(spark, tmp_path):
    root = str(tmp_path / "log")
    events = S.control_events(spark, SF_SMALL)
    keys = ["file_name"]
    assert control_log.state(spark, root, keys) is None
    for k in range(3):
        control_log.append(spark, root, events.where(F.col("seq") % 4 == k))
    control_log.compact(spark, root, keys)
    control_log.append(spark, root, events.where(F.col("seq") % 4 == 3))
    want = sorted(map(str, latest_state(events, keys).collect()))
    assert sorted(map(str, control_log.state(spark, root, keys).collect())) == want
    snapshot = transaction.manifest(spark, root)["tables"]["control_log"]["folders"]
    assert len(snapshot) == 2                                                      # a snapshot and the tail
    control_log.compact(spark, root, keys)
    assert sorted(map(str, control_log.state(spark, root, keys).collect())) == want
    assert control_log.events(spark, root).count() == len(want)
    assert len(transaction.sweep(spark, root, keep=1, open_hours=0)) >= 4


def test_multistatus_entities_cdata_comments(spark, tmp_path):
    (tmp_path / "l.xml").write_text("""<?xml version="1.0"?><x:multistatus xmlns:x="DAV:">
<x:response><x:href>/d/</x:href><x:propstat><x:prop><x:resourcetype><x:collection/></x:resourcetype></x:prop></x:propstat></x:response>
<!-- <x:response><x:href>/d/hidden.zip</x:href></x:response> -->
<x:response><x:href>/d/a&#38;b&#x20;c.zip</x:href><x:propstat><x:prop><x:other/></x:prop><x:status>404</x:status></x:propstat>
<x:propstat><x:prop><x:resourcetype/><x:getcontentlength> 12 </x:getcontentlength><x:getetag>&quot;e1&quot;</x:getetag></x:prop></x:propstat></x:response>
<x:response><x:href><![CDATA[/d/c&d.zip]]></x:href><x:propstat><x:prop><x:getcontentlength>x</x:getcontentlength><x:getetag><![CDATA["e<2"]]></x:getetag></x:prop></x:propstat></x:response>
</x:multistatus>""")
    got = {r["name"]: (r["is_dir"], r["size"], r["etag"]) for r in listing.webdav_listing(spark, str(tmp_path / "l.xml")).collect()}
    assert got == {"a&b c.zip": (False, 12, "e1"), "c&d.zip": (False, None, "e<2")}

