from __future__ import annotations

from lodespark.llm import storage


def test_a_folder_has_the_scheme_of_its_file_system(spark):
    folder = storage.new_folder(spark, "kind")
    assert folder.startswith("file:/") and "/kind-" in folder
    with storage.replacing(f"{folder}/a.bin") as out:
        out.write(b"\1\2")
    assert storage.mapped(f"{folder}/a.bin", "u1").tolist() == [1, 2]
