"""Scratch folders and what is left of them."""

import os

from lifespans.llm import storage


def test_release_deletes_what_was_made(spark, monkeypatch):
    monkeypatch.setattr(storage, "_made", [])
    scratch = storage.Scratch(spark, "t")
    assert scratch.table(spark.range(3), "numbers").count() == 3
    folder = scratch.root.removeprefix("file://")
    scratch.drop("numbers")
    assert not os.path.exists(f"{folder}/numbers")
    scratch.table(spark.range(3), "numbers")
    storage.release()
    assert not os.path.exists(folder) and not storage._made
