"""Archives and encoded text read as streams (CLN2, CLN4)."""

import gzip
import io
import os
import tarfile
import zipfile

import pytest

from tidemark.sources import archives as A
from tidemark.sources import text as X


def _tar(path, members, mode):
    with tarfile.open(path, mode) as t:
        for name, body in members:
            info = tarfile.TarInfo(name)
            info.size = len(body)
            t.addfile(info, io.BytesIO(body))


def test_members_in_chunks_and_whole_again(spark, tmp_dir):
    long = bytes(range(256)) * 400
    members = [("a/b.bin", long), ("empty", b""), ("../out", b"no"), ("/abs", b"no"), ("a/../../up", b"no"), ("a/b.bin", b"again")]
    _tar(os.path.join(tmp_dir, "t.tar"), members, "w")
    _tar(os.path.join(tmp_dir, "u.TGZ"), members, "w:gz")
    with zipfile.ZipFile(os.path.join(tmp_dir, "z.zip"), "w", zipfile.ZIP_DEFLATED) as z:
        z.mkdir("a")
        for name, body in members[:5]:
            z.writestr(name, body)
    with gzip.open(os.path.join(tmp_dir, "one.csv.gz"), "wb") as f:
        f.write(long)
    chunks = X.expand_archives(spark, tmp_dir, chunk=1000)
    assert chunks.selectExpr("max(octet_length(content)) m").first()["m"] == 1000
    whole = {(os.path.basename(r["archive"]), r["member"], r["place"]): bytes(r["content"]) for r in X.whole_members(chunks).collect()}
    tar = {("a/b.bin", 0): long, ("empty", 1): b"", ("a/b.bin", 5): b"again"}
    assert whole == {**{("t.tar", *k): v for k, v in tar.items()}, **{("u.TGZ", *k): v for k, v in tar.items()},
                     ("z.zip", "a/b.bin", 0): long, ("z.zip", "empty", 1): b"", ("one.csv.gz", "one.csv", 0): long}


def test_no_archives_and_missing_folders(spark, tmp_dir):
    assert X.expand_archives(spark, tmp_dir).count() == 0
    with pytest.raises(Exception, match="nowhere"):
        X.expand_archives(spark, os.path.join(tmp_dir, "nowhere")).count()


def test_a_member_is_never_held_whole(tmp_dir):
    """300 MB of one member pass through chunks of 1 MB; a whole copy would show in the peak."""
    import tracemalloc

    from tidemark.sources.csv_files import _store

    path = os.path.join(tmp_dir, "big.tar.gz")

    class Zeros(io.RawIOBase):
        def readinto(self, b):
            b[:] = bytes(len(b))
            return len(b)

        def readable(self):
            return True

    with tarfile.open(path, "w:gz", compresslevel=1) as t:
        info = tarfile.TarInfo("big.bin")
        info.size = 300 << 20
        t.addfile(info, io.BufferedReader(Zeros()))
    reader = A._ArchiveReader({"paths": f'["{tmp_dir}"]', "chunk": str(1 << 20)})
    assert _store(path)[1] == path
    tracemalloc.start()
    total = sum(b.column("content")[i].as_buffer().size for part in reader.partitions() for b in reader.read(part) for i in range(b.num_rows))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert total == 300 << 20
    assert peak < 30 << 20


@pytest.mark.parametrize("limit", [1, 2, 3, 7, 1 << 20])
@pytest.mark.parametrize("encoding", ["utf-8", "utf-16", "utf-16-le", "utf-16-be", "shift_jis"])
def test_lines_across_chunk_ends(limit, encoding):
    body = "a\r\n\n表 b\nlast"
    got = [line for lines in A._decoded(io.BytesIO(body.encode(encoding)), encoding, limit) for line in lines]
    assert got == body.split("\n")
    ended = [line for lines in A._decoded(io.BytesIO((body + "\n").encode(encoding)), encoding, limit) for line in lines]
    assert ended == body.split("\n")
    assert not [line for lines in A._decoded(io.BytesIO(b""), encoding, limit) for line in lines]


def test_encoded_lines_are_numbered_and_wrong_bytes_fail(spark, tmp_dir):
    for name in ("x.txt", "y.txt"):
        with open(os.path.join(tmp_dir, name), "wb") as f:
            f.write(f"{name}\nb\n\n".encode("utf-16"))
    rows = X.read_lines(spark, os.path.join(tmp_dir, "*.txt"), "UTF-16").collect()
    assert sorted((os.path.basename(r["file"]), r["line_no"], r["value"]) for r in rows) == [
        (n, i, v) for n in ("x.txt", "y.txt") for i, v in enumerate([n, "b", ""])]
    bad = os.path.join(tmp_dir, "bad.dat")
    with open(bad, "wb") as f:
        f.write(b"\xff\xfe\x00")
    with pytest.raises(Exception, match="decode|truncated"):
        X.read_lines(spark, bad, "UTF-16").count()
