"""Sweeps and grids run over everything they name; a small one is fitted in earnest."""

from presswork.catalog import models as cm
from presswork.catalog.registry import CLASSES
from presswork.operators import validation as va

FOLDER = "/root/testdata/sf0.001"


def test_grids_are_whole(spark, monkeypatch):
    monkeypatch.setattr(cm, "document_vectors", lambda *_: None)
    monkeypatch.setattr(va, "grid_search_linear", lambda df, settings, classes: settings)
    assert cm.grid_search_logistic(None, FOLDER) == va.logistic_grid()
    assert {(s["loss"], s["l1"]) for s in va.svm_grid()} == set(va.MARGINS)
    assert {s["tol"] for s in va.svm_grid()} == set(va.TOLERANCES) and {s["c"] for s in va.svm_grid()} == set(va.PENALTIES)
    monkeypatch.setattr(va, "grid_search", lambda df, settings, make, classes, **_: settings)
    assert cm.grid_search_tree(None, FOLDER) == va.tree_grid()


def test_sweep_has_every_family_and_percentile(spark, monkeypatch):
    assert set(cm.SWEPT) == {"words", "ngrams", "chars"}
    monkeypatch.setattr(cm, "SWEPT", {"words": cm.WORDS})
    vectors = cm.document_vectors(spark, FOLDER)
    monkeypatch.setattr(cm, "document_vectors", lambda *_: vectors)
    tables = cm.sweep_tables(spark, FOLDER)
    chosen = [f"count-words-{p}" for p in cm.PERCENTS]
    families = tables["count-words"][2]
    assert set(tables) == {"vectors", "count-words", "tfidf-words"} and list(families) == ["count-words", *chosen]
    sizes = [int(families[name].sum()) for name in chosen]
    width = tables["count-words"][1]
    assert sizes == [width * p // 100 for p in cm.PERCENTS] and sizes[0] > 0 and tables["tfidf-words"][1] == width
    assert all((families[a] <= families[b]).all() for a, b in zip(chosen, chosen[1:]))
    got = va.feature_sweep(tables, CLASSES).collect()
    assert {(r.family, r.class_id) for r in got} == {(f, c) for f in ("vectors", "count-words", "tfidf-words", *chosen) for c in range(len(CLASSES))}
    assert all(r.distance <= 1e-4 for r in got)
    only = cm.sweep_tables(spark, FOLDER, whole=False)
    assert set(only) == {"count-words"} and list(only["count-words"][2]) == chosen
