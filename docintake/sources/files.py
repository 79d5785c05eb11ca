"""Files in any store that a URI names, opened by tasks themselves."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame


def file_system(path: str):
    """The ``pyarrow`` file system of a path, by its URI, and the path there. It knows shared file
    systems, HDFS and object stores."""
    # Made of local names only, so that it can travel to executors inside other functions.
    import pyarrow.fs

    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return pyarrow.fs.LocalFileSystem(), path.rstrip("/")
    if scheme == "file":
        return pyarrow.fs.LocalFileSystem(), "/" + rest.strip("/")
    known = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}
    found, there = pyarrow.fs.FileSystem.from_uri(f"{known.get(scheme, scheme)}:{rest}")
    return found, there.rstrip("/")


def opener() -> Callable[[str], BinaryIO]:
    """A function that opens a file for reading at any place. It needs no installed module of
    this package on the executors."""
    import types

    # By value: a function that is pickled by name would need this package there.
    system_of = types.FunctionType(file_system.__code__, {"__builtins__": __builtins__})

    def open_file(path: str) -> BinaryIO:
        import io

        system, there = system_of(path)
        return io.BufferedReader(system.open_input_file(there))

    return open_file


def list_folders(folders: DataFrame) -> DataFrame:
    """The files of many folders, each listed by a task where it lies: ``folder, path, length``.

    ``folders`` have a ``folder``. Spark's own listing is one task to a folder, and sees to all
    folders of a pattern. Like it, this names no hidden file, none without a byte, none of
    folders below; a folder that isn't there has no files.
    """
    import types

    # By value, as in ``opener``.
    system_of = types.FunctionType(file_system.__code__, {"__builtins__": __builtins__})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.fs

        for batch in batches:
            found = []
            for folder in batch["folder"]:
                system, there = system_of(folder)
                for file in system.get_file_info(
                    pyarrow.fs.FileSelector(there, allow_not_found=True)
                ):
                    if file.is_file and file.size and file.base_name[0] not in "._":
                        path = f"{folder.rstrip('/')}/{file.base_name}"
                        found.append((folder, path, file.size))
            if found:
                yield pd.DataFrame(found, columns=["folder", "path", "length"])

    tasks = folders.sparkSession.sparkContext.defaultParallelism
    dealt = folders.select("folder").repartition(tasks, "folder")
    return dealt.mapInPandas(run, "folder string, path string, length long")
