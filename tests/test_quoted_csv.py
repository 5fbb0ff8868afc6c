"""CSV with line breaks inside quotes, cut into many blocks, against the reader that takes a file in one piece."""

import random

import pytest

from commentlens.sources import quoted_csv, readers

BLOCK = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def small_blocks(spark):
    before = {k: spark.conf.get(k) for k in (BLOCK, "spark.sql.files.openCostInBytes")}
    for k in before:
        spark.conf.set(k, "64")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def whole(spark, path):
    rows = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"')
    return rows.columns, sorted(map(tuple, rows.collect()), key=repr)


def in_blocks(spark, path):
    rows = readers.read_table(spark, path, multiline=True)
    return rows.columns, sorted(map(tuple, rows.collect()), key=repr)


def field(rng):
    words = ["a", "bc", "é", "x y", "1,2", 'say ""so""', "line\nbreak", "\n", "\n\n", "\n,\"\"\n"]
    text = "".join(rng.choice(words) for _ in range(rng.randrange(12)))
    plain = text.replace("\n", " ").replace(",", ";").replace('"', "")
    return f'"{text}"' if rng.random() < 0.6 else plain


@pytest.mark.parametrize("seed", range(3))
def test_rows_of_the_whole_file(spark, tmp_path, small_blocks, seed):
    rng = random.Random(seed)
    for name in ("a.csv", "b.csv"):
        lines = ["id,comment,label"] + [f"{i},{field(rng)},{field(rng)}" for i in range(60)]
        (tmp_path / name).write_text("\n".join(lines) + "\n", encoding="utf-8", newline="")
        path = str(tmp_path / name)
        assert in_blocks(spark, path) == whole(spark, path)
        assert spark.read.text(path, lineSep="\n").rdd.getNumPartitions() > 10
    assert readers.read_table(spark, str(tmp_path / "*.csv"), multiline=True).count() == 120


def test_one_record_over_many_blocks(spark, tmp_path, small_blocks):
    path = tmp_path / "long.csv"
    text = "line of text\n" * 100
    path.write_text(f'id,comment\n1,"{text}"\n\n2,"b"\n3,"{text}"', encoding="utf-8")
    rows = dict(map(tuple, readers.read_table(spark, str(path), multiline=True).collect()))
    assert rows == {"1": text, "2": "b", "3": text}


def test_stray_quotes_empty_files_and_headers(spark, tmp_path, small_blocks):
    cases = {
        "stray": 'id,comment\n1,5" pipe\n2,"two\nlines"\n3,a "quoted" word\n4,\n',
        "header": 'id,"a long\nheader of two lines, wider than a block of sixty-four bytes in all"\n1,x\n2,"y\nz"\n',
        "only": "id,comment\n",
        "crlf": 'id,comment\r\n1,"x"\r\n2,"y"\r\n',
    }
    for name, text in cases.items():
        path = tmp_path / f"{name}.csv"
        path.write_bytes(text.encode())
        assert in_blocks(spark, str(path)) == whole(spark, str(path)), name


def test_blocks_that_changed(spark, tmp_path, small_blocks):
    path = tmp_path / "a.csv"
    path.write_text("id,comment\n" + "".join(f'{i},"x\ny"\n' for i in range(50)))
    rows = readers.read_table(spark, str(path), multiline=True)
    spark.conf.set(BLOCK, "50")
    with pytest.raises(Exception, match="other blocks"):
        rows.collect()


def test_ends_open():
    for line, shut, opened in [
        ("a,b", False, True), ('a,"b', True, False), ('"a","b"', False, False), ('x"y', False, False),
        ('a,"b""', True, False), ('""', False, True), ('",c', True, False), ('",""', True, False),
    ]:
        assert (quoted_csv.ends_open(line, False), quoted_csv.ends_open(line, True)) == (shut, opened), line
