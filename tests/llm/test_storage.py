import base64
import gzip
import hashlib
import io
import json
import random
import zipfile
import zlib
from collections import Counter

import duckdb
import pyarrow as pa
import pytest

from wakeful.llm import queries, ring, warc, zips

SF = "/root/testdata/sf0.01"


class Counted(io.BytesIO):
    """A file that remembers which ranges were read."""

    def __init__(self, data):
        super().__init__(data)
        self.reads = []

    def read_at(self, n, offset):
        self.reads.append((offset, n))
        return self.getvalue()[offset : offset + n]


@pytest.mark.parametrize("zip64", [False, True])
def test_writer_and_reader_against_zipfile(zip64):
    out = io.BytesIO()
    own = zips.ZipWriter(out, zip64)
    contents = {"archive/data.warc.gz": b"abc" * 5000, "indexes/ü.cdxj": b"", "x": b"1"}
    for name, data in contents.items():
        own.begin(name)
        for i in range(0, len(data), 1000):
            own.write(data[i : i + 1000])
        own.end()
    own.close()
    with zipfile.ZipFile(io.BytesIO(out.getvalue())) as z:
        assert z.testzip() is None and {n: z.read(n) for n in z.namelist()} == contents
    for before in (b"", b"#!/bin/sh\n" * 10):  # also behind other data
        file = pa.BufferReader(before + out.getvalue())
        for m in zips.directory(file, len(before) + out.tell()):
            start = zips.data_start(file, m)
            assert file.read_at(m.size, start) == contents[m.name] and m.crc == zlib.crc32(contents[m.name])


def test_directory_of_foreign_packages():
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.comment = b"PK\x05\x06 not the end" * 3
        with z.open(zipfile.ZipInfo("big"), "w", force_zip64=True) as f:
            f.write(b"z" * 100)
        z.writestr("packed", b"y" * 1000, zipfile.ZIP_DEFLATED)
        for i in range(70_000):  # more members than 16 bits count
            z.writestr(f"m{i}", b"")
    file = pa.BufferReader(data.getvalue())
    found = zips.directory(file, len(data.getvalue()))
    assert len(found) == 70_002 and found[0].size == 100 and found[1].method == zipfile.ZIP_DEFLATED
    assert file.read_at(100, zips.data_start(file, found[0])) == b"z" * 100
    with pytest.raises(ValueError):
        zips.directory(pa.BufferReader(b"x" * 100), 100)


def test_records_are_range_read_without_extraction():
    rng = random.Random(3)
    out = io.BytesIO()
    own = zips.ZipWriter(out)
    own.begin(warc.ARCHIVE)
    index = []
    for i in range(3000):
        data = gzip.compress(warc.record(i, "http://a/", rng.randbytes(3000), None), 1)
        index.append(json.dumps({"id": i, "offset": own.size, "length": len(data)}))
        own.write(data)
    own.end()
    own.begin(warc.INDEX)
    own.write("\n".join(index).encode())
    own.end()
    own.close()
    file = Counted(out.getvalue())
    spans = list(warc.locate(file, out.tell()))
    assert sum(len(x) for _, x in spans) == 3000 and len(spans) > 1
    assert sum(n for _, n in file.reads) < out.tell() / 10  # directory and index only
    offset, lengths = spans[1]
    assert warc.parse(gzip.decompress(file.read_at(lengths[0], offset)))[0] == sum(len(x) for _, x in spans[:1])
    no_index = io.BytesIO()
    own = zips.ZipWriter(no_index)
    own.begin("archive/other.warc.gz")
    own.write(b"".join(gzip.compress(warc.record(i, None, b"p%d" % i, None)) for i in range(50)))
    own.end()
    own.close()
    file = Counted(no_index.getvalue())
    assert [n for _, x in warc.locate(file, no_index.tell()) for n in x] and sum(len(x) for _, x in warc.locate(file, no_index.tell())) == 50


def test_damaged_payload_is_noticed():
    data = warc.record(1, "u", b"payload", None)
    with pytest.raises(ValueError):
        warc.parse(data.replace(b"payload\r\n", b"paylOad\r\n"))


@pytest.mark.parametrize("options", [{}, {"zip64": True, "package_bytes": 1}, {"least_bytes": 2}])
def test_pages_edge_cases(spark, options):
    rows = [(3, "http://a/%41 b\r\n", "x"), (1, None, "x"), (2, "ü", "yy"), (None, "q", "x"), (5, "", None), (6, "z", ""), (6, "z", ""), (None, None, "own"), (7, "l", "long " * 300_000), (8, "l", "long " * 300_000), (9, "w", "yy")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "html payload", "page_id `first`", "url refers_to", "1 sha")
    got = warc.read_warc(warc.write_warc(pages, **options)).collect()
    least = options.get("least_bytes", 0)
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = []
    for i, u, h in rows:
        data = (h or "").encode()
        to = first.get(h or "")
        to = None if to is None or to == i or len(data) < least else to
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((i, u, "response" if to is None else "revisit", to, len(data), digest, data if to is None else None))
    assert sorted(map(str, ((*r[:6], None if r[6] is None else bytes(r[6])) for r in got))) == sorted(map(str, want))
    assert warc.read_warc(warc.write_warc(pages.limit(0), **options)).count() == 0


def test_packages_of_a_folder(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    made = warc.write_warc(pages, folder=f"file://{tmp_path}/in", package_bytes=100_000)
    found = warc.packages_in(spark, f"file://{tmp_path}/in")
    assert found.count() == made.count() > 1
    got = {r["page_id"]: (r["url"], bytes(r["payload"]).decode()) for r in warc.read_warc(found).collect()}
    assert got == {r["page_id"]: (r["url"], r["html"]) for r in pages.collect()}


@pytest.mark.parametrize("name", ["op2_source_mixing", "op3_exact_dedup", "op4_warc_packages"])
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, want = queries.QUERIES[name](spark, SF), con.execute(queries.ORACLE[name])
    order = [d[0] for d in want.description]
    assert set(order) == set(got.columns)
    assert sorted(map(str, map(tuple, got.select(*order).collect()))) == sorted(map(str, want.fetchall()))


# -- ring -------------------------------------------------------------------------


def brute_ring(keys, shards, slack=0.0):
    """Place sorted keys (cell, order) one by one in rounds: own arc, then each next
    virtual node."""
    nodes = ring.virtual_nodes(shards)
    free = ring.bounds(len(keys), shards, slack)
    arcs = {}
    for cell, key in sorted(keys):
        j = next((k for k, (c, _) in enumerate(nodes) if cell <= c), len(nodes))
        arcs.setdefault(j % len(nodes), []).append(((j < len(nodes), cell, key), key))
    waiting = {j: [k for _, k in sorted(v)] for j, v in arcs.items()}
    place = {}
    for hop in range(len(nodes)):
        for j in sorted(waiting):
            shard = nodes[(j + hop) % len(nodes)][1]
            while waiting[j] and free[shard]:
                place[waiting[j].pop(0)] = shard
                free[shard] -= 1
    return place


@pytest.mark.parametrize("slack", [0.0, 0.1])
def test_settle_against_brute_force(slack):
    rng = random.Random(4)
    keys = [(rng.randrange(ring.CELLS) if rng.random() < 0.6 else 777, i) for i in range(700)]
    want = brute_ring(keys, 5, slack)
    runs = ring.settle(Counter(c for c, _ in keys), 5, slack=slack)
    ranked = {}
    for cell, key in sorted(keys):
        ranked.setdefault(cell, []).append(key)
    got, slots = {}, {}
    for r in runs:
        for rank in range(r.low, r.high):
            got[ranked[r.cell][rank]] = r.shard
            slots.setdefault(r.shard, []).append(r.slot + rank - r.low)
    assert got == want
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_ring_moves_few_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    before, after = ({r["doc_id"]: r["shard"] for r in ring.assign_shards(docs, n).collect()} for n in (24, 25))
    assert max(Counter(before.values()).values()) - min(Counter(before.values()).values()) <= 1
    assert len(set(before.values())) == 24 and sum(before[k] != after[k] for k in before) < 0.15 * len(before)


def test_ring_edge_cases(edge, none):
    rows = ring.assign_shards(edge, 24).collect()
    sizes = Counter(r["shard"] for r in rows)
    assert len(rows) == edge.count() and set(sizes.values()) <= {1, 2} and len(sizes) == 24
    assert sorted((r["shard"], r["slot"]) for r in rows) == sorted((s, i) for s, n in sizes.items() for i in range(n))
    text = {r["doc_id"]: r["text"] or "" for r in edge.collect()}
    assert all(r["size"] == len(text[r["doc_id"]].encode()) + 8 for r in rows if r["doc_id"] is not None)
    assert all(r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode()) for r in rows if r["doc_id"] is not None)
    assert ring.assign_shards(none, 24).count() == 0
    one = ring.assign_shards(edge.repartition(3), 24).collect()
    assert sorted(map(str, one)) == sorted(map(str, rows))


def test_ring_spreads_a_repeated_id(spark):
    """A third of the rows under one id: in ring order, no two on one slot, counts even."""
    rows = [(7 if i % 3 == 0 else i, f"t{i % 50}" if i % 6 else "same") for i in range(3000)]
    found = ring.assign_shards(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), 24).collect()
    slots = {}
    for r in found:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(map(len, slots.values())) == [125] * 24
    assert all(sorted(s) == list(range(125)) for s in slots.values())
    again = ring.assign_shards(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 24).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
