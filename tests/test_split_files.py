"""Large files are read by many tasks, with the rows that one task reads."""

import random

import pytest
from pyspark.sql import functions as F

from sparkqa.sources import files as fs
from sparkqa.sources import records as rec


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "307")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def one_task(spark, path, cols):
    """The rows of the CSV reader, which gives a file to one task."""
    d = fs.read_tsv(spark, str(path), cols)
    return [tuple(r) for r in fs.with_file_order(d, "n").orderBy("n").drop("n").collect()]


def split(spark, path, cols):
    d = rec.with_record_order(rec.read_records(spark, str(path), cols, fs.TSV_OPTIONS), "n")
    rows = d.orderBy("n").collect()
    assert [r["n"] for r in rows] == list(range(len(rows)))
    return [tuple(r)[:len(cols)] for r in rows]


def field(rng):
    kind = rng.randrange(8)
    word = "".join(rng.choice("abé 字\U0001F600") for _ in range(rng.randrange(0, 30)))
    if kind < 3:
        return word
    if kind == 3:
        return word + '"' + word  # a quote past the field's start is text
    inner = word + "".join(rng.choice(["\n", '""', "\t", "x", "\n\n", "\ny", " "]) for _ in range(rng.randrange(0, 8 if kind < 7 else 300)))
    return f'"{inner}"'


@pytest.mark.parametrize("seed", range(5))
def test_records_are_those_of_the_csv_reader(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    text = "\n".join("\t".join([f"r{i}", field(rng), field(rng)]) for i in range(40)) + ("\n" if seed % 2 else "")
    if seed == 4:
        text = text.replace("\n", "\r\n") + "\r\n"
    p = tmp_path / "x.tsv"
    p.write_bytes((rec.BOM if seed == 3 else "").encode() + text.encode())
    assert split(spark, p, ["a", "b", "c"]) == one_task(spark, p, ["a", "b", "c"])


def test_several_files_empty_lines_and_a_record_over_many_splits(spark, tmp_path, small_splits):
    d = tmp_path / "d"
    d.mkdir()
    (d / "1.tsv").write_text('1\t"a\n' + "long line without quotes\n" * 40 + 'b"\tt\n\n2\tx\ty\n')
    (d / "2.tsv").write_text('3\t"one\ntwo"\tz\n4\t"' + "q" * 500 + '"\t""\n')
    (d / "3.tsv").write_text("")
    assert split(spark, d, ["a", "b", "c"]) == one_task(spark, d, ["a", "b", "c"])


def test_a_corpus_file_is_many_scan_tasks(spark, tmp_path, small_splits):
    p = tmp_path / "corpus.tsv"
    p.write_text("id\ttext\ttitle\n" + "".join(f'{i}\t"passage {i}\nsecond ""line"""\tT{i}\n' for i in range(200)))
    d = rec._lines(spark, str(p), "\t")
    assert d.rdd.getNumPartitions() > 10 and fs.read_tsv(spark, str(p), ["a"]).rdd.getNumPartitions() == 1
    rows = fs.read_corpus(spark, str(p)).orderBy("row_no").collect()
    assert [(r["row_no"], r["id"], r["text"]) for r in rows] == [(i, str(i), f'passage {i}\nsecond "line"') for i in range(200)]
    assert fs.read_contexts(spark, str(p)).count() == 200


def test_the_bit_of_a_line(spark):
    cases = ['', 'a\tb', '"a', 'a"', '"a"', '"a""', '"a""b', 'x\t"y', 'x\t"y"\t"z', 'x"\t"y"', '"a"b\t"c', '""', '"', '"""', 'a\t""\tb', '"a\tb', 'a""\t"', 'a\t""']
    d = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, s string") \
        .select("i", "s", rec.open_after(F.col("s"), False, "\t").alias("c"), rec.open_after(F.col("s"), True, "\t").alias("o"))

    def walk(line, state):
        for ch in line:
            if ch == '"':
                state = {1: 2, 0: 0, 2: 3, 3: 2}[state]
            elif state != 2:
                state = 1 if ch == "\t" else 0
        return state == 2
    for r in d.collect():
        assert (r["c"], r["o"]) == (walk(r["s"], 1), walk(r["s"], 2)), r["s"]


def json_rows(spark, path, schema, member=None):
    from sparkqa.sources.json_arrays import read_array
    rows = rec.with_record_order(read_array(spark, str(path), schema, member), "n").orderBy("n").collect()
    assert [r["n"] for r in rows] == list(range(len(rows)))
    return [r.asDict(True) for r in rows]


@pytest.mark.parametrize("seed", range(3))
def test_array_elements_are_those_of_the_json_reader(spark, tmp_path, small_splits, seed):
    import json
    rng = random.Random(seed)
    odd = ['[', ']', '{', '}', ',', '"', "\\", "\n", "é", " ", ": ", '"data": [', "x"]
    items = [{"question": "".join(rng.choice(odd) for _ in range(rng.randrange(0, 40 if i % 9 else 400))),
              "answers": [rng.choice(odd) * 3 for _ in range(rng.randrange(4))]} for i in range(24)]
    p = tmp_path / "a.json"
    text = json.dumps(items, indent=rng.choice([1, 4]), ensure_ascii=seed == 1)
    p.write_text((rec.BOM if seed == 2 else "") + text)
    schema = "question string, answers array<string>"
    got = json_rows(spark, p, schema)
    assert [{k: r[k] for k in ("question", "answers")} for r in got] == items
    gold = tmp_path / "g.json"
    gold.write_text(json.dumps({"version": ["x, y", {"question": "no"}], "meta": {"data": [{"question": "inner"}]}, "data": items, "after": [1, 2]}, indent=1))
    got = json_rows(spark, gold, schema, "data")
    assert [{k: r[k] for k in ("question", "answers")} for r in got] == items


def test_arrays_in_several_files_empty_ones_and_one_line(spark, tmp_path, small_splits):
    d = tmp_path / "d"
    d.mkdir()
    (d / "1.json").write_text("[]")
    (d / "2.json").write_text('[{"question": "a", "answers": []}, {"question": "b"}]')
    (d / "3.json").write_text('[\n\n{"question":\n"c"\n}\n,\n{"question": "' + "d" * 900 + '"}\n]\n')
    (d / "4.json").write_text('  [  ]  ')
    got = json_rows(spark, d, "question string, answers array<string>")
    assert [r["question"] for r in got] == ["a", "b", "c", "d" * 900]
    one = spark.read.schema("question string").json(str(d), multiLine=True).collect()
    assert sorted(r["question"] for r in one) == sorted(r["question"] for r in got)


def test_an_array_file_is_many_scan_tasks(spark, tmp_path, small_splits):
    import json
    from sparkqa.sources import json_arrays
    p = tmp_path / "t.json"
    p.write_text(json.dumps([{"question": f"q{i}", "positive_ctxs": [{"text": f"t{i}"}] * (i % 3)} for i in range(100)], indent=1))
    assert json_arrays._lines(spark, str(p)).rdd.getNumPartitions() > 10
    rows = fs.read_training_json(spark, str(p)).orderBy("sample_no").collect()
    assert [r["question"] for r in rows] == [f"q{i}" for i in range(100) if i % 3]
