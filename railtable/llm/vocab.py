"""Where the public tokenizers' files are, and how they reach the tasks: read on the driver, sent with the job."""

from __future__ import annotations

import os

from pyspark import Broadcast
from pyspark.sql import SparkSession

#: Session setting that names the folder of the vocabulary files; unset: where the installed package of public tokenizers has them.
FOLDER = "spark.corpus.tokenizers"


def vocabulary_file(spark: SparkSession, name: str) -> str:
    """Path of a vocabulary file on the driver."""
    if folder := spark.conf.get(FOLDER, None):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def sent_bytes(spark: SparkSession, path: str) -> Broadcast:
    """The file's bytes (a few MB, the size of a vocabulary) as a broadcast: executors need no file of their own."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


class Memo(dict):
    """A dictionary that makes what it lacks and weighs its keys (by their length), so that its owner can empty it at a bound."""

    def __init__(self, make, weigh=len):
        super().__init__()
        self.make, self.weigh, self.size = make, weigh, 0

    def __missing__(self, key):
        got = self[key] = self.make(key)
        self.size += self.weigh(key)
        return got

    def forget(self, entries: int, size: int) -> None:
        """Empties it beyond either bound."""
        if len(self) > entries or self.size > size:
            self.clear()
            self.size = 0
