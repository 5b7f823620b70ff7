import os

import pytest

from strata import FileManifest, list_files, working_folder


def put(folder, name, numbers, when):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as file:
        file.write("\n".join(f'{{"n": {n}}}' for n in numbers))
    os.utime(path, (when, when))


def taken(spark, manifest, folder, **options):
    with manifest.run("load", folder, **options) as run:
        numbers = sorted(r["n"] for r in run.read(spark, "n long", "json", again=options.get("take_rewritten", False)).collect())
        return numbers, sorted(os.path.basename(r["path"]) for r in run.rewritten.collect())


@pytest.fixture
def place(spark):
    base = working_folder(spark, "arrivals")
    return FileManifest(spark, f"{base}/manifest"), f"{base}/files"


def test_a_file_with_an_old_time_that_appears_late_is_read_once(spark, place):
    manifest, folder = place
    put(folder, "a.json", [1, 2], 2_000_000_000)
    assert taken(spark, manifest, folder) == ([1, 2], [])
    put(folder, "b.json", [3], 1_000_000_000)  # written long before the run, visible after it
    assert taken(spark, manifest, folder) == ([3], [])
    put(f"{folder}/day=1", "c.json", [4], 1_500_000_000)
    assert taken(spark, manifest, folder) == ([4], [])
    assert taken(spark, manifest, folder) == ([], [])
    assert list_files(spark, folder).count() == manifest.seen("load").count() == 3


def test_rewritten_files_are_reported_until_they_are_taken(spark, place):
    manifest, folder = place
    put(folder, "a.json", [1], 1_000_000_000)
    put(folder, "b.json", [2], 1_000_000_000)
    taken(spark, manifest, folder)
    put(folder, "a.json", [10, 11], 1_000_000_500)
    for _ in range(2):
        assert taken(spark, manifest, folder) == ([], ["a.json"])
    assert taken(spark, manifest, folder, take_rewritten=True) == ([10, 11], ["a.json"])
    assert taken(spark, manifest, folder) == ([], [])
    put(folder, "b.json", [5], 999_999_000)  # of the same length, with an earlier time
    assert taken(spark, manifest, folder, take_rewritten=True) == ([5], ["b.json"])
    assert taken(spark, manifest, folder) == ([], [])


def test_a_failed_run_is_repeated_and_jobs_are_apart(spark, place):
    manifest, folder = place
    put(folder, "a.json", [1], 1_000_000_000)
    with pytest.raises(RuntimeError), manifest.run("load", folder):
        raise RuntimeError
    assert taken(spark, manifest, folder) == ([1], [])
    with manifest.run("other", folder) as run:
        assert run.new.count() == 1
    with pytest.raises(ValueError), manifest.run("", folder):
        pass


def test_what_appears_during_a_run_is_left_to_the_next(spark, place):
    manifest, folder = place
    put(folder, "a.json", [1], 1_000_000_000)
    with manifest.run("load", folder) as run:
        put(folder, "b.json", [2], 1_000_000_000)
        assert [r["n"] for r in run.read(spark, "n long", "json").collect()] == [1]
    assert taken(spark, manifest, folder) == ([2], [])


def test_no_folder_no_files(spark, place):
    manifest, folder = place
    assert taken(spark, manifest, folder) == ([], [])
