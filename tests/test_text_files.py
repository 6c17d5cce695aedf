"""One file per id: what is written where, and read back."""

import os

import pytest

from marea.plans import tabular_queries
from marea.session import scratch_path
from marea.sources import readers, writers

ROWS = [(n, f"text {n}\nsecond line") for n in range(300)] + [(-5, ""), (7, "again"), (8, None), (None, "no id"), (-6, "ñ €")]


@pytest.fixture
def texts(spark):
    return spark.createDataFrame(ROWS, "n long, t string").coalesce(1)


def read(spark, path):
    return sorted((r["n"] or "", r["value"]) for r in readers.read_texts(spark, path, "n").collect())


def expected():
    found = {}
    for n, text in ROWS:
        found[n] = found.get(n, "") + (text or "") + "\n"
    return sorted(("" if n is None else str(n), text) for n, text in found.items())


def folders(path):
    return [name for _, names, _ in os.walk(path) for name in names]


def test_texts_come_back(spark, tmp_path, texts, monkeypatch):
    monkeypatch.setattr(writers, "FILES_PER_FOLDER", 50)
    path = str(tmp_path / "a folder")
    writers.write_texts(texts, path, "n", "t")
    assert read(spark, path) == expected()
    assert len(folders(path)) == 7 and not any(name.startswith(".") for name in folders(path))
    assert sum(len(names) for _, _, names in os.walk(path)) == len(expected())
    with pytest.raises(FileExistsError):
        writers.write_texts(texts, path, "n", "t")


def test_other_stores_go_through_sparks_writer(spark, tmp_path, texts, monkeypatch):
    make = writers.make_folder
    monkeypatch.setattr(writers, "make_folder", lambda *args: make(*args).replace("file:", "other:"))
    writers.write_texts(texts, str(tmp_path / "x"), "n", "t")
    assert read(spark, str(tmp_path / "x")) == expected()


def test_no_texts(spark, tmp_path, texts):
    writers.write_texts(texts.where("n > 1000"), str(tmp_path / "x"), "n", "t")
    assert read(spark, str(tmp_path / "x")) == []


def test_attempt_that_comes_second_leaves_nothing(tmp_path):
    """Two attempts of one task: the folder of the first stays, that of the second is not seen."""
    (tmp_path / "0-0").mkdir()
    (tmp_path / "0-0" / "n=1.txt").write_text("first\n")
    (tmp_path / ".9-0").mkdir()
    (tmp_path / ".9-0" / "n=1.txt").write_text("second\n")
    writers._publish(str(tmp_path / ".9-0"), str(tmp_path / "0-0"))
    assert (tmp_path / "0-0" / "n=1.txt").read_text() == "first\n"
    with pytest.raises(OSError):
        writers._publish(str(tmp_path / "none"), str(tmp_path / "0-1"))


def test_pages_get_a_file_but_no_folder_each(spark, tmp_path, monkeypatch):
    pages = spark.createDataFrame([(n, f"u{n}", f"<p>{n}</p>") for n in range(200)], "page_id long, url string, html string")
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    used = []
    monkeypatch.setattr(tabular_queries, "scratch_path", lambda *args: used.append(scratch_path(*args)) or used[-1])
    rows = tabular_queries.whole_texts(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, rows)) == [(n, f"<p>{n}</p>\n") for n in range(200)]
    files = [name for _, _, names in os.walk(used[0]) for name in names if name.endswith(".txt")]
    assert len(files) == 200 and len(folders(used[0])) <= 4
