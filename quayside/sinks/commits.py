"""A list of commits in a folder: numbered marks, each made once and never changed.

A mark appears whole by one rename that fails where the mark exists already. Of two writers that
want the same number one gets it; the other sees that it lost, looks at what was committed meanwhile
and tries again with the next number. The rename is atomic on HDFS and near enough on a local disk; a
store without such a rename needs one that refuses to replace.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class CommitLog:
    """Marks ``1, 2, 3, …`` under ``folder``, each with a small JSON body."""

    def __init__(self, spark: SparkSession, folder: str):
        self.folder = folder.rstrip("/")
        self._jvm = spark._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()
        self._files = self._path(self.folder).getFileSystem(self._conf)
        self._bodies: dict[int, dict] = {}

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def _mark(self, number: int):
        return self._path(f"{self.folder}/{number:020d}")

    def newest(self) -> int:
        """The last committed number, 0 before the first."""
        if not self._files.exists(self._path(self.folder)):
            return 0
        names = [status.getPath().getName() for status in self._files.listStatus(self._path(self.folder))]
        return max((int(name) for name in names if name.isdigit()), default=0)

    def body(self, number: int) -> dict:
        if number not in self._bodies:
            stream = self._files.open(self._mark(number))
            try:
                text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            self._bodies[number] = json.loads(text)
        return self._bodies[number]

    def bodies(self, after: int = 0) -> list[dict]:
        """Bodies of all commits after a number, oldest first."""
        return [self.body(n) for n in range(after + 1, self.newest() + 1)]

    def folders(self, pattern: str) -> list[str]:
        return [status.getPath().toString() for status in self._files.globStatus(self._path(pattern)) or ()]

    def size(self, name: str) -> int:
        """Bytes of a folder's files."""
        return self._files.getContentSummary(self._path(name)).getLength()

    def delete(self, name: str) -> bool:
        """Remove a folder that no commit needs any more."""
        return self._files.delete(self._path(name), True)

    def commit(self, number: int, body: dict) -> bool:
        """Make mark ``number``; False where it exists."""
        fresh = self._path(f"{self.folder}/_{uuid.uuid4()}")
        stream = self._files.create(fresh, False)
        stream.write(json.dumps(body).encode())
        stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._files.getUri(), self._conf)
        plain = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self._files.makeQualified(fresh), self._files.makeQualified(self._mark(number)), plain)
            return True
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in error.java_exception.getClass().getName():
                raise
            self._files.delete(fresh, False)
            return False
