"""Directories of files in, reports and stages out."""

from __future__ import annotations

import os

import pytest
from brute_force import assert_scores, record

from termloom import (
    list_documents,
    load_stage,
    num_docs,
    read_documents,
    read_lines,
    report,
    save_stage,
    score,
    score_counts,
    term_counts_with_size,
    write_report,
)
from termloom.__main__ import main
from termloom.sources.files import names_from_paths


def write(folder, files: dict[str, str]) -> str:
    for name, text in files.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text.encode())
    return str(folder)


@pytest.fixture
def mixed(tmp_path):
    return write(
        tmp_path / "in",
        {"doc1": "a b a\n", "doc10": "", "doc3": " \n", "_hidden": "h", ".dot": "h", "sub/doc5": "s"},
    )


def by_doc(frame) -> dict[str, str]:
    rows = frame.collect()
    result = {r.doc: r.text for r in rows}
    assert len(result) == len(rows)
    return result


def test_zero_byte_files_count_and_hidden_ones_do_not(spark, mixed):
    assert by_doc(read_documents(spark, mixed)) == {"doc1": "a b a\n", "doc10": "", "doc3": " \n"}
    assert sorted(r.doc for r in list_documents(spark, mixed).collect()) == ["doc1", "doc10", "doc3"]


def test_lines_keep_every_document(spark, mixed):
    assert num_docs(read_lines(spark, mixed), "line").first().num_docs == 3


@pytest.mark.parametrize("grain, read", [("document", read_documents), ("line", read_lines)])
def test_scores_of_files(spark, mixed, grain, read):
    rows = [("doc1", "a b a"), ("doc10", ""), ("doc3", "")]
    assert_scores(score(read(spark, mixed), grain), rows)
    assert_scores(score(read(spark, mixed), grain, documents=list_documents(spark, mixed)), rows)


def test_glob(spark, mixed):
    assert by_doc(read_documents(spark, mixed, glob="doc1*")).keys() == {"doc1", "doc10"}
    assert list_documents(spark, mixed, glob="doc?").count() == 2


def test_manifest_does_not_hide_equal_names(spark, tmp_path):
    for folder in ("x", "y"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "doc1").write_text("a")
    manifest = spark.createDataFrame([("doc1",)], "doc string")
    folders = [str(tmp_path / "x"), str(tmp_path / "y")]
    with pytest.raises(ValueError, match="doc1"):
        read_documents(spark, folders, manifest=manifest)


def test_manifest_in_place_of_the_listing(spark, mixed):
    manifest = spark.createDataFrame([("doc1",), ("doc10",), ("gone",)], "doc string")
    found = by_doc(read_documents(spark, mixed, manifest=manifest))
    # A file that the manifest does not name is no document.
    assert found == {"doc1": "a b a\n", "doc10": "", "gone": ""}


def test_names_of_any_kind(spark, tmp_path):
    names = {"a b": "x", "a,b=c": "", "50%20": "y", "p+q": "z", "r+ s": "", "\u00e9.txt": "x", "#1?": "q"}
    folder = write(tmp_path / "in", names)
    assert by_doc(read_documents(spark, folder)) == names
    assert by_doc(read_documents(spark, folder, doc_key="path")) == {
        f"file:{folder}/{n}": t for n, t in names.items()
    }


def test_two_files_of_one_name(spark, tmp_path):
    folder = write(tmp_path, {"x/doc1": "a", "y/doc1": "b", "y/doc2": ""})
    paths = [f"{folder}/x", f"{folder}/y"]
    with pytest.raises(ValueError, match="doc1"):
        read_documents(spark, paths)
    with pytest.raises(ValueError, match="doc1"):
        read_lines(spark, paths)
    assert len(by_doc(read_documents(spark, paths, doc_key="path"))) == 3


def test_unknown_key_is_refused(spark, mixed):
    with pytest.raises(ValueError, match="doc_key"):
        read_documents(spark, mixed, doc_key="id")


def test_only_empty_files(spark, tmp_path):
    folder = write(tmp_path / "in", {"doc1": "", "doc2": ""})
    assert by_doc(read_documents(spark, folder)) == {"doc1": "", "doc2": ""}
    assert score(read_documents(spark, folder)).count() == 0


def test_windows_and_old_mac_line_ends(spark, tmp_path):
    folder = write(tmp_path / "in", {"doc1": "a b\r\na\rc\n"})
    assert_scores(score(read_lines(spark, folder), "line"), [("doc1", "a b a c")])


def test_doc_name_of_paths(spark):
    paths = ["hdfs://h:1/x/doc1", "doc2", "/a/b/", ""]
    table = spark.createDataFrame([(p,) for p in paths], "path string")
    assert [r.doc_name for r in names_from_paths(table, "path").collect()] == ["doc1", "doc2", "", ""]


def lines_of(folder: str) -> list[str]:
    parts = sorted(n for n in os.listdir(folder) if n.startswith("part-"))
    return [line for n in parts for line in open(os.path.join(folder, n), encoding="utf-8", newline="\n").read().split("\n")[:-1]]


ORDER = {"doc1": "a z B", "doc10": "a", "doc2": "a"}


def test_report_is_in_byte_order_of_the_packed_key(spark, corpus, tmp_path):
    target = str(tmp_path / "out")
    write_report(report(score(corpus(ORDER))), target)
    keys = [line.split("\t")[0] for line in lines_of(target)]
    assert keys == ["doc10@a", "doc1@B", "doc1@a", "doc1@z", "doc2@a"]
    assert lines_of(target)[1] == "doc1@B\t0.3662040962"
    assert lines_of(target)[0] == "doc10@a\t0.0000000000"


def test_report_replaces_and_sorts_over_many_files(static_plans, corpus, tmp_path):
    target = str(tmp_path / "out")
    documents = {f"d{i}": f"w{i % 17} x{i} \u00e9{i}" for i in range(300)}
    for _ in range(2):
        write_report(report(score(corpus(documents)), places=16), target)
    assert len([n for n in os.listdir(target) if n.startswith("part-")]) > 1
    lines = lines_of(target)
    keys = [line.split("\t")[0].encode() for line in lines]
    assert keys == sorted(keys) and len(keys) == 900
    expected = record(documents.items())
    for line in lines:
        (doc, term), value = line.split("\t")[0].split("@"), float(line.split("\t")[1])
        assert abs(value - expected[doc, term][4]) < 1e-12


def test_report_sorted_within_files_only(static_plans, corpus, tmp_path):
    lines = report(score(corpus({f"d{i}": f"w{i}" for i in range(100)})), order="file")
    assert "rangepartitioning" not in lines._jdf.queryExecution().executedPlan().toString()
    target = str(tmp_path / "out")
    write_report(lines, target)
    for name in os.listdir(target):
        if name.startswith("part-"):
            keys = [x.split("\t")[0] for x in open(os.path.join(target, name)).read().splitlines()]
            assert keys == sorted(keys)
    with pytest.raises(ValueError):
        report(lines, order="some")


ODD = {
    "d 1": 'a" "b "c" \\ \\t # , ; \x01x\x01 \x1f \u00a0 null NULL NaN -- \'',
    "d=2": "me@x.org a=1 n/m \u00e9 \U0001f600 \ufeff",
}


def test_stages_come_back_as_they_were(spark, corpus, tmp_path):
    stage = term_counts_with_size(corpus(ODD))
    rows = sorted(map(tuple, stage.collect()))
    schema = "doc string, term string, word_count bigint, doc_size bigint"
    for form in (None, schema):
        path = str(tmp_path / ("text" if form else "parquet"))
        for _ in range(2):
            save_stage(stage, path, text=form is not None)
        again = load_stage(spark, path, form)
        assert sorted(map(tuple, again.collect())) == rows
        assert [t for _, t in again.dtypes] == ["string", "string", "bigint", "bigint"]


def test_scores_resume_from_a_saved_stage(spark, corpus, tmp_path):
    rows = list(ODD.items()) + [("d3", "")]
    table, path = corpus(rows), str(tmp_path / "counts")
    save_stage(term_counts_with_size(table), path)
    assert_scores(score_counts(load_stage(spark, path), table), rows)


@pytest.mark.parametrize("grain", ["document", "line"])
def test_command_line(spark, mixed, tmp_path, grain):
    target = str(tmp_path / "out")
    main([mixed, target, "--grain", grain, "--places", "4"])
    # ln(3) * 2/3 and ln(3) * 1/3
    assert lines_of(target) == ["doc1@a\t0.7324", "doc1@b\t0.3662"]


def test_very_many_files_are_listed_by_a_task(spark, tmp_path):
    from termloom.sources.files import list_files

    folder = tmp_path / "many"
    folder.mkdir()
    for k in range(20_000):
        (folder / f"doc{k}").touch()
    (folder / "doc7").write_text("abc")
    (folder / "_hidden").touch()
    (folder / "sub").mkdir()
    listed = list_files(spark, str(folder))
    assert listed.count() == 20_000
    assert [(r.name, r.size) for r in listed.where("size > 0").collect()] == [("doc7", 3)]
    assert list_files(spark, str(folder), "doc1*9").count() == sum(
        1 for k in range(20_000) if str(k).startswith("1") and str(k).endswith("9")
    )
    twice = tmp_path / "twice"
    twice.mkdir()
    (twice / "doc7").touch()
    with pytest.raises(ValueError, match="doc7"):
        list_documents(spark, [str(folder), str(twice)])
    assert list_documents(spark, [str(folder), str(twice)], "path").count() == 20_001


def test_command_line_takes_a_manifest(spark, tmp_path):
    from termloom.__main__ import score_files

    folder = tmp_path / "in"
    folder.mkdir()
    for name, text in {"a": "x y", "b": "x", "c": "z", "empty": ""}.items():
        (folder / name).write_text(text)
    (tmp_path / "names").write_text("a\nb\nempty\n")
    for chunk in (None, 1):
        score_files(spark, str(folder), str(tmp_path / "out"), manifest=str(tmp_path / "names"), chunk_bytes=chunk)
        lines = sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect())
        # Three documents, one of them empty; x is in two of them.
        assert lines == ["a@x\t0.2027325541", "a@y\t0.5493061443", "b@x\t0.4054651081"]
