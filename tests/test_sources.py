"""Readers and writers on small files."""

from pyspark.sql import functions as F

from loomframe.operators.relational import recode
from loomframe.sources import files, tables


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_csv_quotes_and_missing_values(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name,x\n1,"a, b",NaN\n2,c,\n3,"q \\"r\\"",2.5\n')
    got = rows(files.read_csv(spark, str(tmp_path), "id int, name string, x double"))
    assert got == [(1, "a, b", None), (2, "c", None), (3, 'q "r"', 2.5)]


def test_sensor_files(spark, tmp_path):
    assert len(files.SENSOR_COLUMNS) == 54
    for subject in (1, 8):
        line = " ".join(["0.01", "24", "NaN", *[str(i / 2) for i in range(51)]])
        (tmp_path / f"subject10{subject}.dat").write_text(line + "\n")
    df = files.read_sensor_files(spark, str(tmp_path), "heart|hand_acc16")
    assert df.columns == ["subject_id", "timestamp", "activity_id", "heart_rate", "hand_acc16_1",
                          "hand_acc16_2", "hand_acc16_3"]
    df = recode(df, "activity_id", files.ACTIVITY_CODES)
    assert rows(df) == [(s, 0.01, 11, None, 0.5, 1.0, 1.5) for s in (101, 108)]


def test_messages_with_missing_headers(spark, tmp_path):
    (tmp_path / "m.json").write_text(
        '{"_id": "1", "body": "x", "headers": {"From": "a@x", "X-bcc": "B"}}\n'
        '{"_id": "2", "headers": {"To": "b@x"}}\n')
    df = files.flat_messages(files.read_messages(spark, str(tmp_path)))
    assert rows(df.select("id", "sender", "rcpt", "bcc")) == [
        ("1", "a@x", None, "B"), ("2", None, "b@x", None)]


def test_corpus_order(spark, tmp_path):
    for name in ("10 - b - x - 1.txt", "2 - a - y - 2.txt", "100 - c.txt", "7-d.txt"):
        (tmp_path / name).write_text(f"text of\n{name}")
    got = [(r["number"], r["name"], r["text"][-5:])
           for r in files.read_corpus(spark, str(tmp_path)).collect()]
    assert got == [(2, "2 - a - y - 2.txt", "2.txt"), (7, "7-d.txt", "d.txt"), (10, "10 - b - x - 1.txt", "1.txt"),
                   (100, "100 - c.txt", "c.txt")]


def test_pairs(spark, tmp_path):
    (tmp_path / "f.txt").write_text("15.25 2.79 \n\n  13.45\t2.69\n")
    assert rows(files.read_pairs(spark, str(tmp_path / "f.txt"), ["t", "w"])) == [
        (13.45, 2.69), (15.25, 2.79)]


def test_pages(spark):
    df = spark.createDataFrame([(1, 2, '<div class="x ad">two &amp; <b>b</b></div><div>no</div>'),
                                (1, 1, '<div id="q" class="ad">one </div><p/><div class="ad">1</div>'),
                                (2, 1, '<div class="bad">no</div>')], "d int, p int, html string")
    got = dict(map(tuple, files.assemble_pages(df, "d", "p", "html", "ad").collect()))
    assert got == {1: "one 1two & b", 2: ""}
    nested = spark.createDataFrame([
        (1, 1, "<div class='ad'>one <div>two</div> three</div> no"), (2, 1, '<DIV id=q CLASS="ad x">UP<br>per</DIV></div>no'),
        (3, 1, "<div class=ad>bare<div class='ad'>in</div></div>"), (4, 1, "<div class='ad'>a < b never closed")],
        "d int, p int, html string")
    got = dict(map(tuple, files.assemble_pages(nested, "d", "p", "html", "ad").collect()))
    assert got == {1: "one two three", 2: "UPper", 3: "barein", 4: "a < b never closed"}


def test_stages_resume_and_refresh(spark, tmp_path):
    calls = []

    def builders(n):
        return {"a": lambda _: calls.append("a") or spark.range(n),
                "b": lambda df: calls.append("b") or df.withColumn("x", F.col("id") * 2)}

    folder = str(tmp_path / "stages")
    assert tables.stages(spark, builders(3), folder).count() == 3
    assert tables.stages(spark, builders(5), folder).count() == 3 and calls == ["a", "b"]
    assert tables.stages(spark, builders(5), folder, refresh=True).count() == 5
    assert calls == ["a", "b", "a", "b"]


def test_tables(spark, tmp_path):
    tables.save_table(spark.range(3), "t_modes", "create", str(tmp_path / "t"))
    tables.save_table(spark.range(2), "t_modes", "append", str(tmp_path / "t"))
    assert spark.table("t_modes").count() == 5
    tables.save_table(spark.range(1), "t_modes", "refresh", str(tmp_path / "t"))
    assert spark.table("t_modes").count() == 1
    assert tables.run_sql(spark, "SELECT count(*) AS n FROM {t} WHERE id >= :low", {"low": 0},
                          t=spark.table("t_modes")).first()[0] == 1


def test_logs_scores_and_submissions(spark, tmp_path):
    log = str(tmp_path / "log")
    line = spark.createDataFrame([(1, "mlp", {"lr": "0.1"})], "id int, model string, p map<string,string>")
    tables.append_results(line, log)
    tables.append_results(line.withColumn("id", F.lit(2)), log)
    got = files.read_results(spark, log, "id int, model string, p string", ["id", "p"])
    assert rows(got) == [(1, '{"lr":"0.1"}'), (2, '{"lr":"0.1"}')]
    tables.save_scores(line, str(tmp_path / "scores"))
    assert spark.read.json(str(tmp_path / "scores")).first()["p"]["lr"] == "0.1"
    counts = spark.createDataFrame([(0, 0, 5), (1, 0, 2)], "y int, yhat int, count long")
    tables.save_matrix(counts, "y", "yhat", [0, 1], str(tmp_path / "matrix"))
    got = spark.read.csv(str(tmp_path / "matrix"), sep=" ", header=True)
    assert rows(got) == [("0", "5", "0"), ("1", "2", "0")]
    tables.save_submission(spark.createDataFrame([(1, "3 4")], "order_id int, products string"),
                           str(tmp_path / "sub"))
    assert rows(spark.read.csv(str(tmp_path / "sub"), header=True)) == [("1", "3 4")]


def test_one_file_per_name_without_a_folder_each(spark, tmp_path):
    df = spark.createDataFrame([*((f"{i} - a.txt", f"é{i}") for i in range(300)), ("7 - a.txt", "é7"), ("8 - a.txt", None),
                                ("none - a.txt", "x")], "name string, line string")
    folders = files.write_each(df, "name", "line", str(tmp_path / "many"))
    assert 1 <= len(folders) <= 4  # the shuffle's tasks, not the names
    got = dict(map(tuple, files.read_corpus(spark, folders).select("name", "text").collect()))
    assert len(got) == 301 and got["7 - a.txt"] == "é7\né7\n" and got["none - a.txt"] == "x\n"
    assert sorted(got["8 - a.txt"]) == sorted("é8\n\n")
    none = files.write_each(df.limit(0), "name", "line", str(tmp_path / "none"))
    assert files.read_corpus(spark, none).count() == 0
    assert files.read_sensor_files(spark, none, "heart").count() == 0


def test_queries_write_few_folders(spark, tmp_path):
    from loomframe.plans import text
    spark.createDataFrame([(i, f"text {i}") for i in range(60)] + [(None, "x"), (-4, None)], "doc_id long, text string"
                          ).write.parquet(str(tmp_path / "documents.parquet"))
    read = text.read_corpus(spark, str(tmp_path))
    assert len({f.rsplit("/", 1)[0] for f in read.inputFiles()}) <= 4
    assert rows(read) == sorted([(i, f"text {i}\n") for i in range(60)] + [(None, "x\n"), (None, "\n")], key=repr)


def test_corpus_files_are_listed_and_read_by_tasks(spark, tmp_path):
    import gzip
    import os
    corpus = tmp_path / "corpus"
    texts = {f"{i} - t.txt": f"é{i}\r\n" for i in range(200)}
    texts |= {"sub/7 - u.txt": "seven", "sub/deep/8 + ü.txt": "eight", "k=1/9%20.txt": "nine", "x.txt": "no number",
              "99999999999999999999.txt": "too long"}
    hidden = {"_h.txt": "no", ".h.txt": "no", "_sub/1.txt": "no", "1.txt._COPYING_": "no", "0 - empty.txt": "", "5.md": "md"}
    for name, text in {**texts, **hidden}.items():
        (corpus / name).parent.mkdir(parents=True, exist_ok=True)
        (corpus / name).write_bytes(text.encode())
    os.symlink("/nowhere", corpus / "6.txt")
    (corpus / "bytes.txt").write_bytes(b"\xff\x00")
    # A folder given twice or below another gives its files once.
    df = files.read_corpus(spark, [str(corpus), f"file:{corpus}/sub", f"{corpus}/"])
    assert not [f for f in df.inputFiles() if f.endswith(".txt")]  # the plan holds no list of the files
    got = [tuple(r) for r in df.select("number", "name", F.col("text").cast("binary")).collect()]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1].encode())
    assert got == sorted(got, key=key) and len(got) == len(texts) + 1
    assert sorted((r[1], bytes(r[2])) for r in got) == sorted(
        [*((n.rsplit("/", 1)[-1], t.encode()) for n, t in texts.items()), ("bytes.txt", b"\xff\x00")])
    assert [r[1] for r in got if r[0] is None] == ["99999999999999999999.txt", "bytes.txt", "x.txt"]
    assert {r[0] for r in got if r[0] is not None} == set(range(200))
    some = files.read_corpus(spark, str(corpus), "[!0-8x]*.{md,txt}").collect()
    assert [r["name"] for r in some] == ["99999999999999999999.txt", "bytes.txt", "9 - t.txt", "9%20.txt",
                                         *[f"{i} - t.txt" for i in range(90, 100)]]
    # Patterns of paths and packed files are left to Spark's reader.
    (corpus / "sub" / "1.txt.gz").write_bytes(gzip.compress(b"packed"))
    assert files.read_corpus(spark, str(corpus), "*.gz").first()["text"] == "packed"
    assert [r["text"] for r in files.read_corpus(spark, f"{corpus}/su*").collect()] == ["seven", "eight"]


def test_only_lines_of_names_that_come_again_move(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([*((f"{i}.txt", f"{i}") for i in range(300)), ("7.txt", "7"), (" 8.txt", None), (" 8.txt", None)],
                               "name string, line string")
    want = sorted([*((f"{i}.txt", f"{i}\n") for i in range(300) if i != 7), ("7.txt", "7\n7\n"), (" 8.txt", "\n\n")])
    for few in (files.FEW_NAMES, 0):
        monkeypatch.setattr(files, "FEW_NAMES", few)
        folders = files.write_each(df, "name", "line", str(tmp_path / f"few{few}"))
        assert rows(files.read_corpus(spark, folders).select("name", "text")) == want and len(folders) <= 4
