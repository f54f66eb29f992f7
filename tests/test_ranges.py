"""Split reading: every cut gives the rows of the reader that takes a file in one piece."""

import random

import pytest

from fichario.schemas import DATASETS
from fichario.sources import ranges
from fichario.sources.registry_files import read_delimited

COLUMNS = DATASETS["Empresas"].columns


def content(count, seed):
    random.seed(seed)
    pieces = ["plain", "", "a;b", 'say ""x""', "two\nlines", '""', "é Ç ÿ", '\n;""\n', " ", '"";""']
    rows = []
    for n in range(count):
        fields = [f"{n:08d}"] + [random.choice(pieces) for _ in range(random.choice([6, 6, 6, 3, 8]))]
        rows.append(";".join(
            f'"{f}"' if any(c in f for c in ';"\n') or random.random() < 0.5 else f for f in fields))
    return ("\n".join(rows) + "\n").encode("latin-1")


def plain(frame):
    return sorted(tuple(v or "" for v in r) for r in frame.select(*COLUMNS).collect())


def placed(frame):
    return [tuple(r) for r in frame.orderBy("source_path", "block_start", "row_id").select(*COLUMNS).collect()]


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_cuts_change_nothing(spark, tmp_path, parts):
    data = content(400, 3)
    (tmp_path / "a.csv").write_bytes(data)
    (tmp_path / "b.csv").write_bytes(content(5, 4).rstrip(b"\n"))
    (tmp_path / "empty.csv").write_bytes(b"")
    size = -(-len(data) // parts)
    found = ranges.read_ranges(spark, str(tmp_path), "Empresas", range_bytes=size)
    assert found.rdd.getNumPartitions() >= parts
    assert plain(found) == plain(read_delimited(spark, str(tmp_path), "Empresas"))
    whole = ranges.read_ranges(spark, str(tmp_path), "Empresas")
    assert placed(found) == placed(whole) and len(placed(whole)) == 405


def test_every_single_cut(tmp_path):
    data = content(12, 9)
    path = tmp_path / "a.csv"
    path.write_bytes(data)
    want = list(ranges.rows_between(str(path), 0, len(data)))
    assert len(want) == 12
    for cut in range(len(data) + 1):
        state = ranges.MAPS[ranges.effect(data[:cut])][ranges.ROW]
        at = ranges.first_row(str(path), cut, state, len(data))
        got = list(ranges.rows_between(str(path), 0, at)) + list(ranges.rows_between(str(path), at, len(data)))
        assert got == want


def test_effects_compose():
    random.seed(2)
    data = bytes(random.choices(b'ab;"\n\r', k=500))
    for cut in (0, 1, 77, 499, 500):
        both = ranges.COMPOSED[ranges.effect(data[:cut]), ranges.effect(data[cut:])]
        assert ranges.MAPS[both] == ranges.MAPS[ranges.effect(data)]
    for state in range(5):
        at = state
        for byte in data:
            at = ranges.STEP[int(ranges._KINDS[byte])][at]
        assert ranges.MAPS[ranges.effect(data)][state] == at
    assert len(ranges.MAPS) < 64


def test_one_row_over_many_ranges_and_odd_ends(spark, tmp_path):
    long = "x\n" * 5_000
    (tmp_path / "a.csv").write_bytes(f'1;"{long}";;\r\n\r\n2;"b"c;"";d\r\n3;"no end\n;;\n'.encode("latin-1"))
    found = ranges.read_ranges(spark, str(tmp_path), "Empresas", range_bytes=700)
    rows = [r[:4] for r in placed(found)]
    assert rows == [("1", long, None, None), ("2", "bc", "", "d"), ("3", "no end\n;;\n", None, None)]
