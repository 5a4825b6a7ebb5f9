"""WARC files and the Merkle audit against direct comparison."""

import glob
import gzip
import random
from collections import Counter

from pyspark.sql import functions as F

from tracewarden.llm import warc
from tracewarden.session import new_folder

SCHEMA = "page_id long, url string, html string, file string"


def pages(spark):
    rng = random.Random(1)
    rows = [(i, f"http://h/{i}", "".join(rng.choice("abc <é>\n") for _ in range(rng.randrange(0, 400))), "x") for i in range(700)]
    rows += [(None, None, None, None), (5, "http://h/5", rows[5][2], "x"), (900, "a\r\nb: c", "", "x"), (901, "u", "long " * 60_000, "x")]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def replicas(spark, frame, monkeypatch, damaged=None):
    monkeypatch.setattr(warc, "FILE_BYTES", 6000)
    monkeypatch.setattr(warc, "GROUP_BYTES", 6000)
    folders = [f"file://{new_folder(spark, n)}" for n in ("test-a", "test-b")]
    return warc.write(frame, folders, damaged), folders


def test_files_are_warc(spark, monkeypatch):
    frame = pages(spark)
    records, folders = replicas(spark, frame, monkeypatch)
    got = Counter()
    for path in glob.glob(folders[0].removeprefix("file://") + "/*.warc.gz"):
        content = open(path, "rb").read()
        for a, b in warc.ranges(content)[1:]:
            head, body = gzip.decompress(content[a:b]).split(b"\r\n\r\n", 1)
            assert head.startswith(b"WARC/1.0\r\nWARC-Type: resource\r\n")
            got[body.removesuffix(b"\r\n\r\n").decode()] += 1
    assert got == Counter(r.html or "" for r in frame.collect())
    assert records.count() == frame.count()
    a, b = (warc.nodes(spark, f) for f in folders)
    assert warc.audit(a, b).collect() == []


def test_damage_is_found(spark, monkeypatch):
    frame = pages(spark)
    hurt = F.col("page_id") % 37 == 0
    records, folders = replicas(spark, frame, monkeypatch, hurt)
    first, second = (sorted(glob.glob(f.removeprefix("file://") + "/*.warc.gz")) for f in folders)
    assert len(first) > 20
    cut, header, tail, gone = (second[i] for i in (1, 4, 7, 10))
    data = open(cut, "rb").read()
    open(cut, "wb").write(data[:-3])
    open(tail, "ab").write(b"more")
    head = bytearray(open(header, "rb").read())
    head[30] ^= 255
    open(header, "wb").write(head)
    import os
    os.remove(gone)
    # What a comparison of all ranges says.
    want = Counter()
    for k, path in enumerate(first):
        a = open(path, "rb").read()
        b = open(second[k], "rb").read() if k != 10 else None
        ra, rb = warc.ranges(a), warc.ranges(b) if b is not None else []
        name = path.rsplit("/", 1)[1]
        for i in range(max(len(ra), len(rb))):
            if i >= len(rb):
                want[name, i, "missing"] += 1
            elif i >= len(ra):
                want[name, i, "extra"] += 1
            elif a[slice(*ra[i])] != b[slice(*rb[i])]:
                want[name, i, "changed"] += 1
    found = warc.audit(*(warc.nodes(spark, f) for f in folders))
    got = Counter((f"g{r.grp:07d}-{r.file:05d}.warc.gz", r.idx, r.status) for r in found.collect())
    assert got == want and {s for _, _, s in want} == {"changed", "missing", "extra"}


def test_query_form(spark):
    got = warc.audited_replicas(pages(spark), F.col("page_id") % 37 == 0).collect()
    assert Counter(r.page_id for r in got) == Counter(range(0, 700, 37))
    assert {r.status for r in got} == {"changed"}
    assert warc.audited_replicas(pages(spark).limit(0)).collect() == []
