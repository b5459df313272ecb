"""Listing a folder: nothing left out, nothing one by one on the driver."""

from __future__ import annotations

import os

from caseloom.sources import manifest


def test_a_listing_in_pieces_has_every_file_once(spark, tmp_path, monkeypatch):
    names = [f"case {k}.txt" for k in range(30)] + ["_hidden.md", "_empty.md", "empty.txt", ".dot", "a+b%20 c;d.txt", "é中.txt"]
    for name in names:
        (tmp_path / name).write_text("" if "empty" in name else "text of " + name)
    (tmp_path / "folder").mkdir()
    (tmp_path / "folder" / "deeper.txt").write_text("x")
    want = sorted((name, os.path.getsize(tmp_path / name)) for name in names)
    monkeypatch.setattr(manifest, "PIECES", 2)
    for chunk in (3, 1000):
        found = manifest.list_folder(spark, str(tmp_path), chunk=chunk).collect()
        assert sorted((r.name, r.length) for r in found) == want
        assert all(r.path.endswith("/" + r.name) for r in found)


def test_the_driver_makes_few_calls_however_many_files(spark, tmp_path):
    """Calls to the JVM grow with the pieces of a listing and not with its entries."""
    counts = []
    for n in (20, 400):
        folder = tmp_path / str(n)
        folder.mkdir()
        for k in range(n):
            (folder / f"{k}.txt").write_text("x")
        client = spark.sparkContext._gateway._gateway_client
        sent, plain = [], client.send_command
        # Without the notes that an object is no longer needed, which come at any time.
        def counted(command, *args, plain=plain, sent=sent, **options):
            if not command.startswith("m"):
                sent.append(command)
            return plain(command, *args, **options)

        client.send_command = counted
        try:
            listed = manifest.list_folder(spark, str(folder))
        finally:
            del client.send_command
        assert listed.count() == n
        counts.append(len(sent))
    assert counts[1] < counts[0] + 200


def test_files_that_spark_does_not_list_are_looked_at_in_several_tasks(spark, tmp_path):
    for k in range(40):
        (tmp_path / f"_{k}.txt").write_text("x" * k)
    paths = manifest._paths(spark, *manifest.check_input_path(spark, str(tmp_path)), 7)
    looked = manifest._looked_at(paths)
    assert sum(n > 0 for n in looked.rdd.glom().map(len).collect()) > 1
    assert sorted(r.length for r in looked.collect()) == list(range(40))
