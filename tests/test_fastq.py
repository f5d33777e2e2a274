import gzip
import random

import pytest

from sitewise.sources import fastq as S
from sitewise.sources import readers, sinks


def records(n, seed=1):
    """Qualities that begin with @ and +, empty reads, and names with @."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        k = r.randrange(0, 30)
        out.append((f"n{i} @x+", "".join(r.choices("ACGTN", k=k)), "".join(r.choices("@+I#", k=k))))
    return out


def text(rows, end="\n"):
    return "".join(f"@{n}{end}{s}{end}+{end}{q}{end}" for n, s, q in rows)


@pytest.mark.parametrize("step", [1, 2, 3, 7, 50, 1000, 10**6])
def test_each_record_is_in_one_range(tmp_path, step):
    rows = records(40)
    path = tmp_path / "a.fastq"
    path.write_text(text(rows))
    size, got = path.stat().st_size, []
    for at in range(0, size, step):
        for batch in S.read_piece(str(path), at, min(size, at + step), block=37):
            got += [tuple(x.values()) for x in batch.select(["name", "seq", "qual"]).to_pylist()]
    assert got == rows


def test_ends_of_lines_and_of_files(tmp_path):
    rows = records(9)
    for name, body in (("crlf", text(rows, "\r\n")), ("open", text(rows).rstrip("\n")), ("blank", text(rows) + "\n\n")):
        if name == "open" and not rows[-1][1]:
            continue
        (tmp_path / name).write_bytes(body.encode())
        got = [tuple(x.values())[2:] for b in S.read_piece(str(tmp_path / name), 0, len(body)) for x in b.to_pylist()]
        assert got == rows, name
    for name, body in (("cut", text(rows) + "@n\nAC\n"), ("plus", "@n\nAC\n-\nII\n")):
        (tmp_path / name).write_text(body)
        with pytest.raises(ValueError, match="reads file"):
            list(S.read_piece(str(tmp_path / name), 0, len(body)))


def test_plain_packed_and_mixed_folders(spark, tmp_path):
    plain, packed = records(500, 2), records(60, 3)
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "TK1_S1.fastq").write_text(text(plain))
    with gzip.open(tmp_path / "f" / "TK2_S1.fastq.gz", "wt") as f:
        f.write(text(packed[:30]))
    with gzip.open(tmp_path / "f" / "TK2_S1.fastq.gz", "at") as f:  # a second member
        f.write(text(packed[30:]))
    (tmp_path / "f" / "_SUCCESS").write_text("")
    size = (tmp_path / "f" / "TK1_S1.fastq").stat().st_size
    for path in (str(tmp_path / "f"), f"file://{tmp_path}/f", str(tmp_path / "f" / "*.fastq*")):
        df = readers.fastq(spark, path, split_bytes=size // 50)
        assert df.rdd.getNumPartitions() >= 50
        got = df.orderBy("library_id", "read_no").collect()
        assert [(r.library_id, r.name, r.seq, r.qual) for r in got] == [("TK1", *x) for x in plain] + [("TK2", *x) for x in packed]
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_small_files_share_a_task(tmp_path):
    files = [(f"a{i}", 10) for i in range(7)] + [("b.gz", 1000), ("c", 95)]
    tasks = S.pieces_of(files, 30)
    assert [x for t in tasks for x in t if x[0] != "c"] == [(f"a{i}", 0, 10) for i in range(7)] + [("b.gz", 0, 1000)]
    assert [x for t in tasks for x in t if x[0] == "c"] == [("c", 0, 30), ("c", 30, 60), ("c", 60, 90), ("c", 90, 95)]
    assert max(len(t) for t in tasks) == 3


def test_lines_give_the_same_reads_and_empty_folders_none(spark, tmp_path):
    rows = records(50, 4)
    df = spark.createDataFrame(rows, "name string, seq string, qual string")
    sinks.reads_text(df.coalesce(1), str(tmp_path / "x"))
    for read in (readers.fastq, readers.fastq_by_lines):
        assert sorted(map(tuple, read(spark, str(tmp_path / "x")).select("name", "seq", "qual").collect())) == sorted(rows)
    (tmp_path / "none").mkdir()
    assert readers.fastq(spark, str(tmp_path / "none")).count() == 0


def test_small_ranges_are_a_bounded_number_of_tasks(tmp_path):
    files = [("a", 3_000_000), ("b", 1_000_001), ("c", 7)]
    pieces = [x for t in S.pieces_of(files, 100) for x in t]
    assert len(S.pieces_of(files, 100)) <= S.MOST_SMALL + len(files)
    for path, size in files:
        ends = [(start, end) for p, start, end in pieces if p == path]
        assert ends[0][0] == 0 and ends[-1][1] == size and all(x[1] == y[0] for x, y in zip(ends, ends[1:]))
    assert len(S.pieces_of([("a", 100 << 40)], 100)) == (100 << 40) // S.SPLIT_BYTES  # and no range is above the usual length


def test_a_small_range_reads_little(tmp_path, monkeypatch):
    path, read = tmp_path / "a.fastq", []
    path.write_text(text([("n", "ACGT" * 500, "IIII" * 500)] * 1000))
    opened = S.opened

    class Counted:
        def __init__(self, stream):
            self.stream, self.seek = stream, stream.seek

        def read(self, n):
            read.append(len(more := self.stream.read(n)))
            return more

    class System:
        def open_input_file(self, inside):
            return Counted(opened(str(path))[0].open_input_file(inside))

    monkeypatch.setattr(S, "opened", lambda p: (System(), p))
    assert sum(b.num_rows for b in S.read_piece(str(path), 1_000_000, 1_010_000)) == 3
    assert sum(read) < 300_000
