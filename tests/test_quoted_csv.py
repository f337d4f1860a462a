import random
from collections import Counter

import pytest

from threadlens.sources import quoted_csv as qc
from threadlens.sources.tables import CSV_TEXT

SCHEMA = "a string, b string, c string"
SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def split_at(spark):
    """Set the size of a split; with a smaller opening cost Spark cuts small files by the number of cores."""
    names = (SPLIT, "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def at(size):
        spark.conf.set(names[0], size)
        spark.conf.set(names[1], size)

    yield at
    for name, value in before.items():
        spark.conf.set(name, value)


def plain(spark, path, header=True, **options):
    """What Spark gives with one task per file."""
    read = spark.read.schema(SCHEMA).options(**{**CSV_TEXT, "header": header, **options}, multiLine=True)
    return Counter(tuple(r) for r in read.csv(path).collect())


def found(spark, path, **options):
    return Counter(tuple(r) for r in qc.read_quoted_csv(spark, path, SCHEMA, **options).collect())


TRICKY = 'a,b,c\n1,"two\nlines","x"\n2,"say ""hi""\n\n""\n",y\n3,,"""\n"""\n"4,\n5",plain,"\n\n\nend"\n6,no quotes at all,z\n'


def test_every_split_size(spark, tmp_path, split_at):
    """Splits at every offset of a text with quotes, doubled quotes and line breaks."""
    path = tmp_path / "t.csv"
    path.write_text(TRICKY, newline="")
    expected = plain(spark, str(path))
    assert sum(expected.values()) == 5
    for size in [*range(1, 14), 17, 29, 50, 90, len(TRICKY) + 1]:
        split_at(size)
        assert found(spark, str(path)) == expected, size


CASES = {
    "no header line": ('1,"x\ny",3\n4,5,6\n', False),
    "header over lines": ('"a\nx",b,c\n1,2,3\n', True),
    "no line end": ('a,b,c\n1,"2\n3",4', True),
    "carriage returns": ('a,b,c\r\n1,"two\r\nlines",3\r\n4,5,"6"\r\n', True),
    "unclosed": ('a,b,c\n1,2,3\n4,"5\n6,7,8\n9', True),
    "empty lines": ('a,b,c\n\n1,2,3\n\n\n4,"\n\n",6\n\n', True),
    "few and many fields": ('a,b,c\n1\n1,2\n1,2,3,4\n"1\n2"\n', True),
    "stray quotes": ('a,b,c\nx"y,2,3\n4,5" 6,"7\n8"\nit\'s 5" by 6",a,b\n9,"z",0\n', True),
    "only a header": ("a,b,c\n", True),
    "nothing": ("", True),
    "letters": ('a,b,c\né,"中\n文","👍\n🏽"\n', True),
    "one long record": ('a,b,c\n1,"' + "line\n" * 60 + '",3\n', True),
}


@pytest.mark.parametrize("name", CASES)
def test_like_one_task_per_file(spark, tmp_path, split_at, name):
    text, header = CASES[name]
    path = tmp_path / "t.csv"
    path.write_text(text, newline="", encoding="utf-8")
    expected = plain(spark, str(path), header)
    for size in (3, 16, 1 << 20):
        split_at(size)
        assert found(spark, str(path), header=header) == expected, size


def random_table(rng, rows):
    some = lambda: "".join(rng.choice(['x', '"', ",", "\n", " ", "ab"]) for _ in range(rng.randint(0, 6)))
    quoted = lambda v: '"' + v.replace('"', '""') + '"' if v and (set('",\n') & set(v) or v != v.strip()) else v
    return "a,b,c\n" + "".join(",".join(quoted(some()) or '""' for _ in range(3)) + "\n" for _ in range(rows))


def test_random_tables(spark, tmp_path, split_at):
    """Several files in a folder, some of them with many records that cross splits."""
    rng = random.Random(4)
    for i in range(4):
        (tmp_path / f"t{i}.csv").write_text(random_table(rng, 40), newline="")
    expected = plain(spark, str(tmp_path))
    assert sum(expected.values()) == 160
    for size in (3, 50, 333):
        split_at(size)
        assert found(spark, str(tmp_path)) == expected, size


def test_tasks_follow_the_splits(spark, tmp_path, split_at):
    """One large file is read by as many tasks as it has splits, each with its share of the rows."""
    path = tmp_path / "large.csv"
    path.write_text("a,b,c\n" + "".join(f'{i},"text with\na break, and ""quotes""",z\n' for i in range(20_000)), newline="")
    split_at(50_000)
    table = qc.read_quoted_csv(spark, str(path), SCHEMA)
    splits = -(-path.stat().st_size // 50_000)
    per_task = [len(p) for p in table.rdd.glom().collect()]
    assert sum(per_task) == 20_000
    assert sum(n > 500 for n in per_task) >= splits - 1 > 10
    assert max(per_task) < 2 * 20_000 / splits
    # Spark's own reader has one task with everything
    single = spark.read.schema(SCHEMA).options(**CSV_TEXT, multiLine=True).csv(str(path))
    assert max(len(p) for p in single.rdd.glom().collect()) == 20_000


def test_other_split_is_noticed(spark, tmp_path, split_at):
    path = tmp_path / "t.csv"
    path.write_text(TRICKY, newline="")
    split_at(10)
    table = qc.read_quoted_csv(spark, str(path), SCHEMA)
    split_at(7)
    with pytest.raises(Exception, match="split in another way"):
        table.collect()


@pytest.mark.parametrize("line,inside,after", [
    ("plain", False, False), ("plain", True, True), ('"open', False, True), ('close"', True, False), ('a,"b', False, True),
    ('a"b', False, False), ('a"b,"c', False, True), ('""', False, False), ('"""', False, True), ('x""y', True, True),
    ('x"""', True, False), ('x"y"z,"', True, True), ('"a"b"c', False, False), ('"a",', False, False), ("", True, True), ("", False, False),
])
def test_inside_after(line, inside, after):
    assert qc.inside_after(line, inside) is after
