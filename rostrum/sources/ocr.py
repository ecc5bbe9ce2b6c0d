"""Scans to text, page by page, with an engine that the caller brings."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame

from ..runtime import ship


class Engine(Protocol):
    """Opens a document: a context that gives its number of pages and a function from page (from 1) to text."""

    def open(self, content: bytes) -> AbstractContextManager[tuple[int, Callable[[int], str]]]: ...


class CommandEngine:
    """Counts, rasterises (300 dpi, grey) and reads pages with the usual command-line programs, one thread each.

    A document is written once to a scratch folder of its task, which is removed behind it.
    """

    def __init__(self, language: str = "eng", dpi: int = 300):
        self.language, self.dpi = language, dpi

    @staticmethod
    def _run(command: list[str]) -> str:
        import os
        import subprocess

        done = subprocess.run(command, capture_output=True, check=True, env=os.environ | {"OMP_THREAD_LIMIT": "1"})
        return done.stdout.decode("utf-8", "replace")

    @contextmanager
    def open(self, content: bytes) -> Iterator[tuple[int, Callable[[int], str]]]:
        import os
        import tempfile

        with tempfile.TemporaryDirectory() as folder:
            source = os.path.join(folder, "in.pdf")
            with open(source, "wb") as file:
                file.write(content)
            said = self._run(["pdfinfo", source])
            count = next((int(x.split(":")[1]) for x in said.splitlines() if x.startswith("Pages:")), 0)

            def text(page: int) -> str:
                image = f"{folder}/page"
                self._run(["pdftoppm", "-r", str(self.dpi), "-gray", "-tiff", "-singlefile", "-f", str(page), "-l", str(page), source, image])
                return self._run(["tesseract", f"{image}.tif", "stdout", "-l", self.language])

            yield count, text


def read_pages(scans: DataFrame, engine: Engine) -> DataFrame:
    """path, year, text: the pages of each scan joined by a blank line; a page that fails is left out, a scan without pages too."""
    ship(scans.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, content, year in zip(batch["path"], batch["content"], batch["year"], strict=True):
                texts = []
                try:
                    with engine.open(bytes(content)) as (count, text):
                        for page in range(1, count + 1):
                            try:
                                texts.append(text(page))
                            except Exception:
                                continue
                except Exception:
                    continue
                if texts:
                    rows.append((path, year, "\n\n".join(texts)))
            yield pd.DataFrame(rows, columns=["path", "year", "text"])

    return scans.select("path", "content", "year").mapInPandas(run, "path string, year int, text string")
