"""Digests of files by the data source, against whole files."""

import hashlib

from addrloom.sources import digests, readers


def test_digests_of_files_of_any_size(spark, tmp_path):
    for k, n in enumerate([0, 1, 99, 100, 101, 5000]):
        (tmp_path / f"f {k}.bin").write_bytes(bytes((j * 7 + k) % 256 for j in range(n)))
    found = readers.discover(spark, [str(tmp_path / "*.bin")])
    files = [(p, (tmp_path / p.rsplit("/", 1)[1]).stat().st_size) for p in found]
    got = digests.digests(spark, files, tasks=3, chunk=100)
    assert got.rdd.getNumPartitions() == 3
    want = {p: (n, hashlib.sha256((tmp_path / p.rsplit("/", 1)[1]).read_bytes()).hexdigest(), None) for p, n in files}
    assert {r.path: (r.size, r.sha256, r.error) for r in got.collect()} == want
    assert {r.path: (r.size, r.sha256, r.error) for r in readers.fingerprints(spark, found).collect()} == want
    assert digests.digests(spark, []).count() == 0 and digests.digests(spark, [files[1]] * 2).count() == 2


def test_what_cant_be_read_is_a_row(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"abc")
    got = {r.path: r for r in digests.digests(spark, [(str(tmp_path / "a"), 4), (str(tmp_path / "gone"), 3)]).collect()}
    assert got[str(tmp_path / "a")].error == "4 bytes when listed, 3 when read" and got[str(tmp_path / "a")].sha256 is None
    assert "FileNotFound" in got[str(tmp_path / "gone")].error


def test_a_file_beyond_a_cell(tmp_path):
    with open(tmp_path / "large", "wb") as f:  # sparse: 2 GB and five bytes, which no cell holds
        f.truncate((2 << 30) + 5)
    with open(tmp_path / "large", "rb") as f:
        want = hashlib.file_digest(f, "sha256").hexdigest()
    assert digests.digest(f"file:{tmp_path}/large") == (f"file:{tmp_path}/large", (2 << 30) + 5, want, None)


def test_tasks_have_like_bytes():
    made = digests.groups([("a", 50), ("b", 30), ("c", 20), ("d", 10), ("e", 9)], 2)
    assert sorted(sum(n for _, n in g.files) for g in made) == [59, 60]
    assert sorted(len(g.files) for g in digests.groups([(str(k), 0) for k in range(25)], 1, most=10)) == [5, 10, 10]
    assert [len(g.files) for g in digests.groups([("a", 1)], 8)] == [1]
