import gzip
import json
import random
import re
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from caseflow import session
from caseflow.operators import nested, quality, tree
from caseflow.sources import lists, readers, writers


def test_required_inputs(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "processos.parquet"))
    names = ["processos.parquet", "movimentos.parquet"]
    rows = {r.arquivo: r.status for r in readers.required_inputs(spark, str(tmp_path), names).collect()}
    assert rows == {"processos.parquet": "OK", "movimentos.parquet": "ERRO"}
    with pytest.raises(readers.MissingInput, match="movimentos"):
        readers.check_required_inputs(spark, str(tmp_path), names)


@pytest.mark.parametrize("text, cases", [
    ("processo\n001\n 002 \n\n003\n", ["001", "002", "003"]),
    ("001\n002\n", ["001", "002"]),
    ("123\nabc\n", ["123", "abc"]),
    ("0-1\n2\n", ["0-1", "2"]),
    ('"processo"\n"001"\n', ["001"]),
])
def test_case_list_header(spark, tmp_path, text, cases):
    (tmp_path / "lista.csv").write_text(text)
    assert sorted(r.processo for r in readers.read_case_list(spark, str(tmp_path)).collect()) == sorted(cases)


def test_case_lists_with_and_without_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("processo\n001\n002\n")
    (tmp_path / "b.csv").write_text("00003\n00004\n")
    got = sorted(r.processo for r in readers.read_case_list(spark, str(tmp_path)).collect())
    assert got == ["00003", "00004", "001", "002"]


def test_one_file_refuses_large_tables(spark, tmp_path):
    with pytest.raises(writers.TooManyRows):
        writers.write_one_csv(spark.range(11), str(tmp_path / "o"), most=10)


def test_files_are_cut_into_documents_while_read(spark, tmp_path):
    """Lists and single documents, printed in several ways, in splits of 64 bytes: every document comes back."""
    rng = random.Random(4)

    def value(depth):
        kind = rng.randrange(7 if depth < 4 else 4)
        if kind < 4:
            return rng.choice([1, None, True, "x}y", '{"a"', 'q\\"}', "back\\\\", "é[]", "", "]},{", "line\nbreak"])
        if kind == 4:
            return [value(depth + 1) for _ in range(rng.randrange(4))]
        return {f"k{i}": value(depth + 1) for i in range(rng.randrange(4))}

    expected = {}
    for i in range(24):
        documents = [{"n": k, "v": value(0), "w": {"x": value(2)}} for k in range(rng.randrange(1, 12))]
        whole = documents if i % 4 else documents[0]
        text = json.dumps(whole, indent=(None, 1, 2)[i % 3], ensure_ascii=i % 2 == 0)
        (tmp_path / f"f{i:02}.json").write_text(("\ufeff" if i % 5 == 0 else "") + text + ("\n" if i % 3 == 0 else ""), encoding="utf-8")
        expected[f"f{i:02}.json"] = documents if i % 4 else documents[:1]
    for name, text in (("empty.json", ""), ("none.json", " [ ] "), ("blank.json", "\n")):
        (tmp_path / name).write_text(text)
    options = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "0"}
    before = {name: spark.conf.get(name) for name in options}
    for name, wanted in options.items():
        spark.conf.set(name, wanted)
    try:
        assert lists.segments(spark, str(tmp_path)).rdd.getNumPartitions() > 24
        rows = lists.documents(spark, str(tmp_path)).collect()
    finally:
        for name, old in before.items():
            spark.conf.set(name, old)
    got = {}
    for r in sorted(rows, key=lambda r: (r._arquivo, r.numero)):
        got.setdefault(r._arquivo.rsplit("/", 1)[1], []).append(json.loads(r.texto))
    assert got == expected


def test_bad_documents_of_a_list_stand_alone(spark, tmp_path):
    def one(number):
        return json.dumps({"metadados": {"numero_processo": number}})

    (tmp_path / "inside.json").write_text(f'[{one("1")}, {{"metadados": nonsense}}, {one("2")}]')
    (tmp_path / "cut.json").write_text(f'[{one("3")}, {one("4")}, {{"metadados": {{"numero_processo": "5"')
    (tmp_path / "open.json").write_text('{"metadados": {"numero_processo": "6"}')
    (tmp_path / "short.json").write_text('{"metadados": 1')
    good, bad = readers.split_rejects(readers.read_organised_documents(spark, str(tmp_path)))
    assert sorted(r.metadados.numero_processo for r in good.collect()) == ["1", "2", "3", "4"]
    assert sorted(r._corrupt_record for r in bad.collect()) == [
        '{"metadados": 1', '{"metadados": nonsense}', '{"metadados": {"numero_processo": "5"', '{"metadados": {"numero_processo": "6"}']


def test_small_files_are_cut_by_the_task_that_reads_them(spark, tmp_path):
    """Compressed or not, files of one split give the documents that files of several give, and shuffle nothing."""
    escaped = r'{"b": {"c": "\\\""}}'
    texts = {
        "list": '[{"a": "x}{"},\n ' + escaped + ', {"d": bad}]\n', "one": '\ufeff{"a": [1, {"b": 2}]}', "open": '{"a": {"b": 1}',
        "cut": '[{"a": 1}, {"b": "}', "none": "[]", "rest": '[{"a": 1}, {"b": {"c": "' + "y" * 300 + '"}, {"d": 1}'}
    for name, text in texts.items():
        (tmp_path / "plain").mkdir(exist_ok=True)
        (tmp_path / "packed").mkdir(exist_ok=True)
        (tmp_path / "plain" / f"{name}.json").write_text(text, encoding="utf-8")
        with gzip.open(tmp_path / "packed" / f"{name}.json.gz", "wt", encoding="utf-8") as file:
            file.write(text)

    def cut(folder):
        return sorted((r._arquivo.rsplit("/", 1)[1].removesuffix(".gz"), r.numero, r.texto)
                      for r in lists.documents(spark, str(tmp_path / folder)).collect())

    expected = sorted([
        ("list.json", 0, '{"a": "x}{"}'), ("list.json", 1, escaped), ("list.json", 2, '{"d": bad}'),
        ("one.json", 0, '{"a": [1, {"b": 2}]}'), ("open.json", 0, '{"a": {"b": 1}'), ("cut.json", 0, '{"a": 1}'),
        ("cut.json", 1, '{"b": "}'), ("rest.json", 0, '{"a": 1}'), ("rest.json", 1, texts["rest"][11:])])
    assert cut("plain") == expected
    # whether a brace closes the last segment of a compressed file is unknown, so a rest may show one more
    assert [x for x in cut("packed") if x[0] != "cut.json"] == [x for x in expected if x[0] != "cut.json"]
    assert "Exchange" not in lists.documents(spark, str(tmp_path / "plain"))._jdf.queryExecution().toString()
    options = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "0"}
    before = {name: spark.conf.get(name) for name in options}
    for name, wanted in options.items():
        spark.conf.set(name, wanted)
    try:
        # of a rest that is cut, the first split is kept
        assert [x for x in cut("plain") if x[:2] != ("rest.json", 1)] == [x for x in expected if x[:2] != ("rest.json", 1)]
    finally:
        for name, old in before.items():
            spark.conf.set(name, old)


def _documents_by_character(text, packed):
    """Segments of a file as Spark reads them and its documents, one character at a time; a rest comes last, unless it is blank."""
    segments = text.split("}")
    braced = [True] * (len(segments) - 1) + [False]
    if segments[-1] == "":
        segments, braced = segments[:-1], braced[:-1]
    base, depth, string, found, begun = int(text.lstrip(" \n").startswith("[")), 0, False, [], ""
    for i, segment in enumerate(segments):
        k = 0
        while k < len(segment):
            if segment[k] == "\\" and segment[k + 1:k + 2] not in ("", "\n"):
                k += 1
            elif segment[k] == '"':
                string = not string
            elif not string:
                depth += {"{": 1, "[": 1, "]": -1}.get(segment[k], 0)
            k += 1
        # whether a brace closes a packed file is unknown: it does if a document is open
        brace = depth > base if packed and i == len(segments) - 1 else braced[i]
        begun += segment + ("}" if brace else "")
        if brace and not string:
            depth -= 1
            if depth == base:
                found.append(begun)
                begun = ""
    trimmed = [re.sub(r"^[ \n]*[\[,]?[ \n]*", "", document) for document in [*found, begun]]
    return segments, trimmed if trimmed[-1].strip(" \n]") else trimmed[:-1]


@pytest.mark.parametrize("size", [1, 3, 7, 1000])
def test_segments_are_cut_in_batches_of_any_size(size):
    """Random text of whole files, plain and packed, whose documents don't depend on where a batch ends."""
    rng = random.Random(size)
    pieces = ["{", "}", "[", "]", '"', "\\", '\\"', ",", " ", "\n", "é", '{"a": "x}{"}', '{"b": {"c": [1]}}, ', "\\\\"]
    rows, expected = [], []
    for i in range(300):
        name = f"file:/f{i}.json" + (".gz" if i % 2 else "")
        text = "".join(rng.choice(pieces) for _ in range(rng.choice([1, 4, 40])))
        text = "[" + text * (i % 3 + 1) if i % 3 else text
        segments, documents = _documents_by_character(text, packed=i % 2 == 1)
        rows += [(name, len(text.encode()), segment) for segment in segments]
        expected += [(name, k, document) for k, document in enumerate(documents)]
    batches = [pa.RecordBatch.from_pylist([dict(zip(("_arquivo", "_size", "value"), row)) for row in rows[i:i + size]])
               for i in range(0, len(rows), size)]
    got = [tuple(row.values()) for batch in lists._cut(iter(batches)) for row in batch.to_pylist()]
    assert got == expected and len(got) > 400


def test_documents_are_parsed_once(spark, tmp_path):
    """A filter on good documents doesn't parse them again, and files of one split are cut without patterns in the plan."""
    (tmp_path / "a.json").write_text('[{"metadados": {"numero_processo": "1"}}, {"metadados": bad}]')
    (tmp_path / "b.ndjson").write_text('{"id": "1"}\n{"id": bad}\n')
    scans = [readers.read_organised_documents(spark, str(tmp_path / "a.json")), readers.read_case_lines(spark, str(tmp_path / "b.ndjson"))]
    for scan in scans:
        good, bad = readers.split_rejects(scan)
        for part in (good, bad):
            assert part.count() == 1
            assert part._jdf.queryExecution().executedPlan().toString().count("from_json(") == 1
    plan = scans[0]._jdf.queryExecution().executedPlan().toString()
    assert "regexp_replace" not in plan and "RLIKE" not in plan


def test_only_files_above_the_least_split_are_read_for_splits(spark, tmp_path):
    for i in range(40):
        (tmp_path / f"f{i}.json").write_text('{"a": 1}')
    (tmp_path / "large.json").write_text("[" + ",".join(['{"a": "' + "x" * 1000 + '"}'] * 100) + "]")
    options = {"spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "4096b"}
    before = {name: spark.conf.get(name) for name in options}
    for name, wanted in options.items():
        spark.conf.set(name, wanted)
    try:
        rows = lists.segments(spark, str(tmp_path))
        assert lists._any_split(spark, rows)
        assert not lists._any_split(spark, lists.segments(spark, str(tmp_path / "f*.json")))
        assert lists.documents(spark, str(tmp_path)).count() == 140
    finally:
        for name, old in before.items():
            spark.conf.set(name, old)


def test_many_small_files_share_a_task(spark, tmp_path):
    tasks = lists.TASKS * spark.sparkContext.defaultParallelism
    for i in range(3 * tasks):
        (tmp_path / f"f{i}.json").write_text(f'[{{"a": {i}}}, {{"b": {i}}}]')
    options = {"spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "4k"}
    before = {name: spark.conf.get(name) for name in options}
    for name, wanted in options.items():
        spark.conf.set(name, wanted)
    try:
        assert lists.segments(spark, str(tmp_path)).rdd.getNumPartitions() == 3 * tasks
        documents = lists.documents(spark, str(tmp_path))
        assert documents.rdd.getNumPartitions() == tasks
        assert sorted(r.texto for r in documents.collect()) == sorted(f'{{"{k}": {i}}}' for i in range(3 * tasks) for k in "ab")
    finally:
        for name, old in before.items():
            spark.conf.set(name, old)


def test_one_document_per_file(spark, tmp_path):
    tree_text = [{"numeroUnico": "r", "sequencial": 0, "instancia": "1", "processos": [
        {"numeroUnico": "a", "sequencial": 1, "instancia": "2", "processos": []}]}]
    full = {
        "metadados": {"numero_processo": "r"}, "resumo": {"valor_causa": "10.5", "total_movimentos": 2},
        "processo": {"dados_basicos": {"nivelSigilo": "x", "juizo100Digital": "true", "outrosParametros": [
            {"nome": "outro", "valor": "1"},
            {"nome": "ARVORE_PROCESSUAL", "valor_estruturado": {"arvoreProcessual": tree_text}}]},
            "movimentos": [{"complementos": ["N", "d", "Por: X - Y"]}, {"complementos": []}]}}
    (tmp_path / "a.json").write_text(json.dumps(full, indent=2))
    (tmp_path / "b.json").write_text(json.dumps({"metadados": {"numero_processo": "s"}, "novo": 1}))
    (tmp_path / "c.json").write_text('{"metadados": {')
    good, bad = readers.split_rejects(readers.read_organised_documents(spark, str(tmp_path)))
    assert bad.count() == 1 and good.count() == 2
    cases = {r.numero_processo: r for r in nested.service_case_table(good).collect()}
    assert (cases["r"].valor_causa, cases["r"].total_movimentos, cases["r"].nivel_sigilo,
            cases["r"].juizo_100_digital) == (10.5, 2, None, True)
    assert cases["s"].valor_causa is None and len(cases["r"]) == 21
    moves = nested.service_movement_table(good).collect()
    assert len(moves) == 2 and len(moves[0]) == 13
    nodes = tree.flatten_trees(tree.tree_of_document(good)).collect()
    assert {(r.numero_processo, r.numero_pai) for r in nodes} == {("r", None), ("a", "r")}
    record = nested.summary_records(good).filter("numero_processo is null").orderBy("_arquivo_origem").first()
    assert record.valor_causa == "10,5" and record._arquivo_origem.endswith("a.json")


def test_csv_quotes_and_leading_zeros(spark, tmp_path):
    rows = [("001", 'Vara de "A", Cível'), ("002", "x")]
    path = writers.write_one_csv(spark.createDataFrame(rows, "processo string, nome string"), str(tmp_path / "o"))
    files = [p for p in (tmp_path / "o").iterdir() if p.suffix == ".csv"]
    assert len(files) == 1
    assert files[0].read_text() == 'processo,nome\n001,"Vara de ""A"", Cível"\n002,x\n'
    assert path.endswith("/o")


def test_aggregate_layout(spark):
    frame = spark.createDataFrame([("z", None, "f", 1)], "b string, a string, _arquivo_origem string, total_codigos_nacionais int")
    out = writers.aggregate_layout(frame)
    assert out.columns == ["_arquivo_origem", "total_codigos_nacionais", "a", "b"]
    assert tuple(out.first()) == ("f", "1", "", "z")


def test_read_back(spark, tmp_path):
    frame = spark.range(5).withColumn("x", F.col("id") * 2)
    path = writers.write_parquet(frame, str(tmp_path / "t"))
    assert writers.check_read_back(spark, path, frame).first().linhas == 5
    with pytest.raises(writers.ExportMismatch):
        writers.check_read_back(spark, path, frame.limit(4))
    with pytest.raises(Exception, match="exists"):
        writers.write_parquet(frame, path)


def test_checked_write_reads_its_source_once(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    source = spark.range(1000, numPartitions=4).mapInPandas(count, "id long")
    report = writers.write_checked(source.withColumn("x", F.when(F.col("id") % 10 > 0, 1)), str(tmp_path / "t"),
                                   gate=quality.null_gate(["x"])).first()
    assert (report.linhas, report.mesmas_linhas, report.mesmo_esquema, report.linhas_com_na) == (1000, True, True, 100)
    assert reads.value == 1000
    with pytest.raises(quality.QualityError, match="movs"):
        quality.gate_written(spark.createDataFrame([report]), "movs")
    empty = writers.write_checked(spark.range(0), str(tmp_path / "e"), gate=quality.null_gate(["id"])).first()
    assert (empty.linhas, empty.mesmas_linhas, empty.linhas_com_na) == (0, True, 0)


def test_versions_are_published_whole_or_not_at_all(spark, tmp_path):
    root = str(tmp_path / "table")
    with pytest.raises(writers.NoVersion):
        writers.read_published(spark, root)
    assert writers.publish(spark.range(3), root) == 1
    broken = spark.range(5).select(F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).alias("id"))
    with pytest.raises(Exception, match="lost"):
        writers.publish(broken, root)  # fails while writing: no pointer
    assert writers.read_published(spark, root).count() == 3 and writers.published_versions(spark, root) == [1]
    (tmp_path / "table" / "_versions" / "2").touch()  # a writer that died between its pointer and the content
    assert writers.read_published(spark, root).count() == 3
    assert writers.publish(spark.range(7), root) == 3
    assert writers.read_published(spark, root).count() == 7 and writers.read_published(spark, root, 1).count() == 3


def test_only_one_writer_wins_a_version(spark, tmp_path):
    root = str(tmp_path / "table")
    writers.publish(spark.range(3), root)
    base = writers.published_versions(spark, root)[-1]  # both writers start from version 1
    assert writers.publish(spark.range(4), root, expected=base) == 2
    with pytest.raises(writers.VersionConflict):
        writers.publish(spark.range(5), root, expected=base)
    assert writers.read_published(spark, root).count() == 4


class FakeSession:
    """Only what the folder choice looks at."""

    def __init__(self, folder, master):
        self.conf = SimpleNamespace(get=lambda name, default=None: folder if name == "spark.checkpoint.dir" else default)
        self.sparkContext = SimpleNamespace(master=master)


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_dir(spark) != session.shared_dir(spark)
    assert session.shared_dir(FakeSession("hdfs://x/shared/", "yarn")).startswith("hdfs://x/shared/caseflow-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(FakeSession(None, "yarn"))
