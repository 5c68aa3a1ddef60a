"""Files on any file system Arrow opens: located by URI, read by ranges, copied in pieces, written under another name first."""

from __future__ import annotations

import hashlib
import uuid
from contextlib import contextmanager

import pyarrow as pa

PIECE_BYTES = 4 << 20


def located(path: str):
    """The Arrow file system of a path or URI, and the path on it."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    uri = "s3://" + path[6:] if path.startswith("s3a://") else path
    try:
        return fs.FileSystem.from_uri(uri)
    except (pa.ArrowInvalid, OSError) as failure:
        raise OSError(f"no file system of Arrow opens {path}: {failure}") from failure


def parent(path: str) -> str:
    return path.rsplit("/", 1)[0] if "/" in path else ""


def is_folder(path: str) -> bool:
    from pyarrow import fs

    system, own = located(path)
    return system.get_file_info(own).type == fs.FileType.Directory


def entries(system, folder: str, suffix: str) -> list[tuple[str, bool]]:
    """Path and whether it is a folder of what lies right in a folder: folders, and files whose names end in ``suffix``.

    Hidden names are left out, as Spark's readers do.
    """
    from pyarrow import fs

    hidden = lambda name: name.startswith(".") or name.startswith("_") and "=" not in name
    wanted = lambda x: x.type == fs.FileType.Directory or x.type == fs.FileType.File and x.base_name.endswith(suffix)
    return [(x.path, x.type == fs.FileType.Directory) for x in system.get_file_info(fs.FileSelector(folder)) if wanted(x) and not hidden(x.base_name)]


def pieces(handle, size: int = PIECE_BYTES):
    while piece := handle.read(size):
        yield piece


@contextmanager
def whole(path: str, check=None):
    """A stream to a file that is written under a name of its own first and moved when it is there whole.

    A task that is lost in between leaves no file of the given name; a file that was there is replaced as one.  ``check`` is
    called with the file system and the own name before the move.
    """
    fs, target = located(path)
    if parent(target):
        fs.create_dir(parent(target), recursive=True)
    own = f"{target}.{uuid.uuid4().hex}.part"
    try:
        with fs.open_output_stream(own) as out:
            yield out
        if check:
            check(fs, own)
        fs.move(own, target)
    except BaseException:
        try:
            fs.delete_file(own)
        except OSError:
            pass  # it was never made
        raise


def written(path: str, parts) -> tuple[int, str]:
    """Bytes and sha256 of what is written whole, having been read back."""
    digest, size = hashlib.sha256(), 0

    def check(fs, own):
        with fs.open_input_stream(own) as back:
            again = hashlib.sha256()
            for part in pieces(back):
                again.update(part)
        if again.digest() != digest.digest():
            raise OSError(f"{path} holds other bytes than were written")

    with whole(path, check) as out:
        for part in parts:
            out.write(part)
            digest.update(part)
            size += len(part)
    return size, digest.hexdigest()


def copied(source: str, target: str) -> tuple[int, str]:
    """Bytes and sha256 of a file copied piece by piece."""
    fs, path = located(source)
    with fs.open_input_stream(path) as handle:
        return written(target, pieces(handle))


class Counted:
    """A random-access file that counts the bytes it reads."""

    def __init__(self, handle):
        self.handle, self.read_bytes, self.size = handle, 0, handle.size()

    def at(self, offset: int, n: int) -> bytes:
        self.handle.seek(offset)
        data = self.handle.read(n)
        self.read_bytes += len(data)
        return data
