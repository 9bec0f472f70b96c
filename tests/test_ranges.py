import bz2
import gzip
import random
import struct
import zlib

import pyarrow as pa
import pytest

from sporemill.sources import scans


def blocked(data: bytes, size: int) -> bytes:
    out = b""
    for i in [*range(0, len(data), size), len(data)]:
        c = zlib.compressobj(6, zlib.DEFLATED, -15)
        part = data[i : i + size]
        body = c.compress(part) + c.flush()
        out += bytes.fromhex("1f8b08040000000000ff0600") + b"BC\x02\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(part), len(part))
    return out


def records_of(text: str):
    lines = text.replace("\r\n", "\n").removesuffix("\n").split("\n")
    return [(i // 4, lines[i][1:], *lines[i + 1 : i + 2], *lines[i + 3 : i + 4]) for i in range(0, len(lines), 4)]


@pytest.fixture(scope="module")
def text():
    rng = random.Random(1)
    rows = []
    for i in range(700):
        n = rng.choice([1, 3, 40, 400])
        rows.append(f"@r{i} é\n{''.join(rng.choices('ACGTN', k=n))}\n+{rng.choice(['', f'r{i} é'])}\n{rng.choice('@+I')}{''.join(rng.choices('@+I5', k=n - 1))}\n")
    return "".join(rows)


def read(spark, path, size):
    df = scans.fastq(spark, str(path), range_bytes=size)
    return sorted((r.rec_no, r.title, r.seq, r.qual) for r in df.collect()), df


@pytest.mark.parametrize("size", [1700, 10**6])
def test_ranges_of_plain_files(spark, tmp_path, text, size):
    (tmp_path / "a.fastq").write_text(text.removesuffix("\n"))
    got, df = read(spark, tmp_path / "a.fastq", size)
    assert got == records_of(text) and df.where("reason is not null").count() == 0


@pytest.mark.parametrize("size", [2500, 10**6])
def test_ranges_of_block_gzip(spark, tmp_path, text, size):
    (tmp_path / "b.fastq.gz").write_bytes(blocked(text.encode(), 3000))
    assert gzip.decompress((tmp_path / "b.fastq.gz").read_bytes()).decode() == text
    got, df = read(spark, tmp_path / "b.fastq.gz", size)
    assert got == records_of(text) and df.where("reason is not null").count() == 0


def test_gzip_members_and_line_ends(spark, tmp_path, text):
    half = text.index("@r350")
    (tmp_path / "c.fastq.gz").write_bytes(gzip.compress(text[:half].encode()) + gzip.compress(text[half:].encode()))
    (tmp_path / "empty.fastq").write_text("")
    assert read(spark, tmp_path, 5000)[0] == records_of(text)
    for codec in ("bz2", "zstd"):
        packed = pa.compress(text.encode(), codec, asbytes=True) if codec == "zstd" else bz2.compress(text.encode())
        (tmp_path / f"g.fastq.{codec[:3]}").write_bytes(packed)
        assert read(spark, tmp_path / f"g.fastq.{codec[:3]}", 9000)[0] == records_of(text)
    (tmp_path / "d.fastq").write_bytes(text.replace("\n", "\r\n").encode())
    assert read(spark, tmp_path / "d.fastq", 7000)[0] == records_of(text)


def test_malformed_regions_lose_nothing(spark, tmp_path, text):
    """Each line of the file is in one record, and what follows the next range's first title is read again."""
    lines = text.split("\n")
    lines[2:160:4] = ["x"] * 40
    broken = "\n".join(lines) + "@end\nAC\n"
    (tmp_path / "e.fastq").write_text(broken)
    for size in (3333, 10**6):
        df = scans.fastq(spark, str(tmp_path / "e.fastq"), range_bytes=size)
        rows = df.collect()
        assert sorted(r.rec_no for r in rows) == list(range(701)) and sum(r.reason == "malformed" for r in rows) == 41
    dropped = text.replace("+\n", "", 1)  # a line is missing: records go wrong until the next range
    (tmp_path / "f.fastq").write_text(dropped)
    good = [scans.fastq(spark, str(tmp_path / "f.fastq"), range_bytes=s).where("reason is null").count() for s in (5000, 10**6)]
    assert good[0] > 600 > good[1]


def test_records_are_not_shuffled(spark, tmp_path, text):
    (tmp_path / "a.fastq").write_text(text)
    plan = scans.fastq(spark, str(tmp_path / "a.fastq"), numbered=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInArrow") < plan.index("Exchange") and plan.count("Exchange") == 1  # of ranges only


def test_mates_are_not_broadcast(spark, tmp_path):
    for mate in ("R1", "R2", "I1"):
        (tmp_path / f"x_{mate}.fastq").write_text("".join(f"@r{i}\n{mate[0]}ACGT\n+\nIIIII\n" for i in range(300)))
    sides = [scans.fastq(spark, str(tmp_path / f"x_{mate}.fastq"), range_bytes=1000) for mate in ("R1", "R2", "I1")]
    paired = scans.pairs(*sides)
    assert sorted((r.rec_no, r.read_id, r["index"]) for r in paired.collect()) == [(i, f"r{i}", "IACGT") for i in range(300)]
    # the scans are as large as the files, whatever a list of ranges weighs
    assert "Broadcast" not in paired._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.mark.parametrize("size", [700, 10**7])
def test_mates_are_read_in_step(spark, tmp_path, size):
    """As pairs() of three scans, also where files end early, in a blank line or lack; and no record is shuffled."""
    def write(name, records, packed=False, tail=""):
        data = ("".join(f"@{i} x\n{s}\n+\n{'I' * len(s)}\n" for i, s in records) + tail).encode()
        (tmp_path / name).write_bytes(gzip.compress(data) if packed else data)

    for i in range(3):
        write(f"a{i}_R1.fastq", [(f"a{i}_{n}", "ACGT" * (n % 7 + 1)) for n in range(150)], tail="\n" if i == 1 else "")
        write(f"a{i}_R2.fastq", [(f"a{i}_{n}", "TTGCA" * (n % 4 + 1)) for n in range((150, 120, 190)[i])], packed=i == 0)
        write(f"a{i}_I1.fastq", [(f"a{i}_{n}", "GG") for n in range(140)])
    write("b_R2.fastq", [(f"b_{n}", "CCC") for n in range(60)])
    sides = [str(tmp_path / f"*_{mate}.fastq") for mate in ("R1", "R2", "I1")]
    want = scans.pairs(*[scans.fastq(spark, path, range_bytes=size) for path in sides])
    got = scans.mates(spark, *sides, range_bytes=size)
    rows = lambda df: sorted(((r.pair, r.rec_no, r.read_id, r.r1, r.r2, r["index"]) for r in df.collect()), key=lambda r: r[:2])
    assert rows(got) == rows(want) and len(rows(got)) == 150 + 150 + 190 + 60
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "Join" not in plan and plan.index("MapInArrow") < plan.index("Exchange")  # of pieces of work only
