"""Message files as page texts. Reading scans needs a text recogniser, which is a plug-in: any function from
the bytes of a file to the texts of its pages. A page that fails has an empty text; a file that fails has an error."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from importlib import import_module

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@lru_cache(8)
def recogniser(name: str) -> Callable[[bytes], list]:
    """`module:factory`, made once in each Python worker."""
    module, _, factory = name.partition(":")
    return getattr(import_module(module), factory)()


def plain_text():
    """A recogniser of files that are text already; form feeds end pages. Scans and other bytes that aren't text are an
    error, so that these files are read again once there is a recogniser for them."""

    def read(data: bytes) -> list[str]:
        if data[:1024].lstrip().startswith(b"%PDF"):
            raise ValueError("a PDF file, which needs a recogniser")
        if b"\0" in data:
            raise ValueError("no text, which needs a recogniser")
        return data.decode("utf-8").split("\f")

    return read


def read_pages(files: DataFrame, name: str = "ledgerloom.sources.pages:plain_text", page_no: int | None = None) -> DataFrame:
    """(file_path, file_name, page_no, text, error) of binaryFile rows; of one page only if it is named, and no others
    are then recognised, if the recogniser gives pages as functions."""

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        read = recogniser(name)
        for b in batches:
            rows = []
            for path, content in zip(b["path"], b["content"]):
                try:
                    pages = read(bytes(content))
                except Exception as e:  # one file must not stop the others
                    rows.append((path, path.rpartition("/")[2], 0, None, str(e)))
                    continue
                for k, page in enumerate(pages):
                    if page_no is not None and k + 1 != page_no:
                        continue
                    try:
                        rows.append((path, path.rpartition("/")[2], k + 1, page() if callable(page) else page, None))
                    except Exception as e:  # nor one page the others
                        rows.append((path, path.rpartition("/")[2], k + 1, "", str(e)))
            yield pd.DataFrame(rows, columns=["file_path", "file_name", "page_no", "text", "error"])

    return files.select(F.col("path"), F.col("content")).mapInPandas(run, "file_path string, file_name string, page_no int, text string, error string")
