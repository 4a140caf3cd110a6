"""Byte-exact landing, its manifest, and CSV files as they come."""

import hashlib
import os

import pytest

from reelstack import sources as src
from reelstack.schemas import MOVIES_CSV
from reelstack.session import scratch_path
from reelstack.sources.landing import BOM
from reelstack.storage import Store

from .conftest import rows

DAY = "2024-04-12"
NAMES = MOVIES_CSV.names


def local(path):
    return path.removeprefix("file:")


def landed_bytes(folder):
    folder, out = local(folder), b""
    for at in sorted(os.listdir(folder)):
        parts = [n for n in os.listdir(f"{folder}/{at}") if n.startswith("part-")]
        assert len(parts) == 1
        out += open(f"{folder}/{at}/{parts[0]}", "rb").read()
    return out


@pytest.fixture()
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "256")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


CONTENTS = {
    "crlf.csv": b"a|b|c\r\n1|x\ry|3\r\n",
    "open end.csv": b"a|b\n1|2",
    "one+char=50%.csv": b"z",
    "accent.csv": "a|b\né|1\nü".encode(),
    "bom.csv": b"\xef\xbb\xbfa|b\n1|2\n",
    "bom_open.csv": b"\xef\xbb\xbfa",
    "blank.csv": b"\n\n\r\n \n",
    "latin.csv": b"caf\xe9|1\n\xff\xfe\x00|2\n",
    "empty.csv": b"",
    "long.csv": b"".join(b"%d|%s\n" % (i, b"x" * (i % 300)) for i in range(900)) + b"y" * 9000 + b"|no line end",
}


def test_landed_bytes_are_the_source_bytes(spark, tmp_path, small_splits):
    root = scratch_path(spark, "Raw")
    for name, content in CONTENTS.items():
        (tmp_path / name).write_bytes(content)
    landed = src.land_raw(spark, str(tmp_path), root, DAY)
    folders = {n for n in os.listdir(local(landed)) if n.startswith("file=")}
    assert len(folders) == len(CONTENTS)
    listed = src.manifest(spark, landed)
    for name, content in CONTENTS.items():
        folder = f"{landed}/file=" + name.replace("%", "%25").replace("=", "%3D")
        assert hashlib.sha256(landed_bytes(folder)).digest() == hashlib.sha256(content).digest(), name
        mine = listed.filter(listed.folder == folder).collect()
        assert sum(r.bytes for r in mine) == len(content), name
        for r in mine:
            assert hashlib.sha256(open(local(f"{folder}/{r.part}"), "rb").read()).hexdigest() == r.sha256
    assert len(os.listdir(local(f"{landed}/file=long.csv"))) > 5
    assert src.verify_landing(spark, landed).count() == 0
    changed = [d for d, _, fs in os.walk(local(f"{landed}/file=crlf.csv")) for f in fs if f.startswith("part-")][0]
    part = [f for f in os.listdir(changed) if f.startswith("part-")][0]
    os.remove(f"{changed}/.{part}.crc")
    open(f"{changed}/{part}", "ab").write(b"more\n")
    assert [r.folder for r in src.verify_landing(spark, landed).collect()] == ["file=crlf.csv"]


def test_landing_again_replaces_only_that_file_and_leaves_no_rest(spark, tmp_path, small_splits):
    root = scratch_path(spark, "Raw")
    long, short = b"h\n" + b"line\n" * 3000, b"h\nnew\n"
    (tmp_path / "a.csv").write_bytes(long)
    (tmp_path / "b.csv").write_bytes(long)
    landed = src.land_raw(spark, str(tmp_path), root, DAY)
    (tmp_path / "a.csv").write_bytes(short)
    src.land_raw(spark, str(tmp_path / "a.csv"), root, DAY)
    assert landed_bytes(f"{landed}/file=a.csv") == short and landed_bytes(f"{landed}/file=b.csv") == long
    assert not [n for n in os.listdir(local(landed)) if n.startswith("_staging")]


def test_a_landing_that_fails_leaves_the_earlier_one(spark, tmp_path, monkeypatch):
    from reelstack.sources import landing
    root = scratch_path(spark, "Raw")
    (tmp_path / "a.csv").write_bytes(b"old\n")
    landed = src.land_raw(spark, str(tmp_path / "a.csv"), root, DAY)
    (tmp_path / "a.csv").write_bytes(b"new\n")
    monkeypatch.setattr(landing, "_check", lambda *a: (_ for _ in ()).throw(IOError("lost")))
    with pytest.raises(IOError):
        src.land_raw(spark, str(tmp_path / "a.csv"), root, DAY)
    assert landed_bytes(f"{landed}/file=a.csv") == b"old\n"
    assert sorted(os.listdir(local(landed))) == ["_manifest", "file=a.csv"]


def csv(order, ids, **values):
    row = lambda i: "|".join({**dict.fromkeys(NAMES, "v"), **values, "id": i}[c] for c in order)
    return [row(i) for i in ids]


def write(path, header, lines, end="\n"):
    path.write_text(end.join(([("|".join(header))] if header else []) + lines) + end, newline="")


TURNED = list(reversed(NAMES))


def read(spark, tmp_path, land, **options):
    """The CSV files of a folder, as they are or landed."""
    path = str(tmp_path)
    if land:
        path = src.land_raw(spark, path, scratch_path(spark, "Raw"), DAY)
    return src.scan_csv_pipe(spark, path, **options)


@pytest.mark.parametrize("land", [False, True])
def test_a_file_without_header_beside_two_orders_raises(spark, tmp_path, land):
    write(tmp_path / "a.csv", NAMES, csv(NAMES, ["a1"]))
    write(tmp_path / "b.csv", TURNED, csv(TURNED, ["b1"]))
    assert rows(read(spark, tmp_path, land), "id", "tituloPincipal") == [("a1", "v"), ("b1", "v")]
    write(tmp_path / "c.csv", None, csv(NAMES, ["c1", "c2"]))
    with pytest.raises(ValueError, match="no header"):
        read(spark, tmp_path, land)


def test_two_headers_in_one_landed_file_raise(spark, tmp_path):
    write(tmp_path / "a.csv", NAMES, csv(NAMES, ["a1"]))
    write(tmp_path / "b.csv", TURNED, csv(TURNED, ["b1"]))
    landed = src.land_raw(spark, str(tmp_path), scratch_path(spark, "Raw"), DAY, name="movies.csv")
    with pytest.raises(ValueError, match="two headers"):
        src.scan_csv_pipe(spark, landed)
    (tmp_path / "b.csv").unlink()
    write(tmp_path / "c.csv", None, csv(NAMES, ["c1", "c2"]))
    landed = src.land_raw(spark, str(tmp_path), scratch_path(spark, "Raw"), DAY, name="movies.csv")
    assert rows(src.scan_csv_pipe(spark, landed), "id") == [("a1",), ("c1",), ("c2",)]
    assert rows(src.scan_csv_pipe(spark, f"{landed}/file=movies.csv"), "id") == [("a1",), ("c1",), ("c2",)]


@pytest.mark.parametrize("land", [False, True])
def test_carriage_returns(spark, tmp_path, land):
    """CRLF ends lines, a lone CR is a character of its field."""
    write(tmp_path / "a.csv", NAMES, csv(NAMES, ["a1", "a2"], personagem="x\ry"), end="\r\n")
    got = read(spark, tmp_path, land)
    assert rows(got, "id", "personagem", "titulosMaisConhecidos") == [("a1", "x\ry", "v"), ("a2", "x\ry", "v")]


@pytest.mark.parametrize("land", [False, True])
def test_line_breaks_in_quotes(spark, tmp_path, small_splits, land):
    """Records of many lines, also across splits, keep their line breaks."""
    want = {}
    lines = []
    for i in range(300):
        text = "one line" if i % 3 else "first\nsecond | third\n" + "w" * (i * 7) + "\n\nlast ""\"quoted\"" + "\nend"
        want[f"t{i}"] = text
        lines += csv(NAMES, [f"t{i}"], personagem='"' + text.replace('"', '""') + '"')
    write(tmp_path / "a.csv", NAMES, lines)
    got = read(spark, tmp_path, land)
    assert {r.id: r.personagem for r in got.collect()} == want and got.count() == 300
    assert got.filter("titulosMaisConhecidos = 'v'").count() == 300
    with pytest.raises(ValueError, match="odd number of quotes"):
        read(spark, tmp_path, land, quoted_newlines="raise")


def test_quotes_that_do_not_pair_up(spark, tmp_path):
    write(tmp_path / "a.csv", NAMES, csv(NAMES, ["a1", "a2"]) + csv(NAMES, ["a3"], personagem='5" tall'))
    with pytest.raises(ValueError, match="pair up"):
        read(spark, tmp_path, False)
    got = read(spark, tmp_path, False, quoted_newlines="lines")
    assert rows(got, "id", "personagem") == [("a1", "v"), ("a2", "v"), ("a3", '5" tall')]


def test_repeated_and_blank_header_names(spark, tmp_path):
    header = [*NAMES, "", "id"]
    write(tmp_path / "a.csv", header, [line + "|x|other" for line in csv(NAMES, ["a1"])])
    assert rows(read(spark, tmp_path, True), "id") == [("a1",)]


def test_two_files_of_one_name_raise(spark, tmp_path):
    for folder in ("x", "y"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "a.csv").write_text("h\n")
    with pytest.raises(ValueError, match="two files"):
        src.land_raw(spark, str(tmp_path), scratch_path(spark, "Raw"), DAY)


def test_the_driver_calls_do_not_grow_with_the_files(spark, tmp_path, monkeypatch):
    calls = []
    for name in ("exists", "ends", "delete", "make", "names"):
        plain = getattr(Store, name)
        monkeypatch.setattr(Store, name, lambda self, *a, _f=plain, _n=name, **k: (calls.append(_n), _f(self, *a, **k))[1])
    counts, root = [], scratch_path(spark, "Raw")
    for n in (3, 30):
        folder = tmp_path / str(n)
        folder.mkdir()
        for i in range(n):
            (folder / f"{n}_{i}.csv").write_bytes(BOM * (i % 2) + b"k|v\n%d|x" % i + b"\n" * (i % 3))
        calls.clear()
        landed = src.land_raw(spark, str(folder), root, DAY)
        counts.append(len(calls))
        assert src.verify_landing(spark, landed).count() == 0
        for i in range(n):
            assert landed_bytes(f"{landed}/file={n}_{i}.csv") == (folder / f"{n}_{i}.csv").read_bytes()
    assert counts[0] == counts[1]
