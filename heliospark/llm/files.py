"""Files in the shared folder, written and read by tasks through the folder's own filesystem."""

from __future__ import annotations

import os


def _filesystem(uri: str):
    from pyarrow import fs
    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), os.path.abspath(uri)


def writer(uri: str):
    system, path = _filesystem(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(path, compression=None)


def batches_of(uri: str):
    """Record batches of a Parquet table."""
    from pyarrow import dataset
    system, path = _filesystem(uri)
    return dataset.dataset(path, filesystem=system, format="parquet").to_batches()


class RangeReader:
    """Byte ranges of files; keeps the last file open."""

    def __init__(self):
        self.uri, self.file = None, None

    def __call__(self, uri: str, offset: int, length: int) -> bytes:
        if uri != self.uri:
            self.close()
            system, path = _filesystem(uri)
            self.uri, self.file = uri, system.open_input_file(path)
        return self.file.read_at(length, offset)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.file = None
