"""Small file-system calls on the driver: names and markers, never row data."""

from __future__ import annotations

from pyspark.sql import SparkSession


class FileSystem:
    """The Hadoop file system behind a path, as Spark itself would open it."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self.path(path).getFileSystem(self._conf)

    def path(self, text: str):
        return self._jvm.org.apache.hadoop.fs.Path(text)

    def uri(self) -> str:
        return self._fs.getUri().toString() + "/"

    def exists(self, path: str) -> bool:
        return self._fs.exists(self.path(path))

    def is_dir(self, path: str) -> bool:
        return self.exists(path) and self._fs.getFileStatus(self.path(path)).isDirectory()

    def mkdirs(self, path: str) -> None:
        self._fs.mkdirs(self.path(path))

    def delete(self, path: str) -> bool:
        return self._fs.delete(self.path(path), True)

    def rename(self, source: str, target: str) -> None:
        if not self._fs.rename(self.path(source), self.path(target)):
            raise OSError(f"cannot rename {source} to {target}")

    def list(self, path: str) -> list[str]:
        """Names directly below ``path``, sorted; empty when it is absent."""
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self.path(path)))

    def glob(self, root: str, pattern: str) -> list[str]:
        """Full names below ``root`` that fit the pattern, from one call; empty when there are none."""
        plain = "".join(f"\\{c}" if c in "{}[]*?\\" else c for c in root)
        found = self._fs.globStatus(self.path(f"{plain}/{pattern}"))
        return sorted(s.getPath().toString() for s in found or [])

    def modified(self, path: str) -> int:
        """Latest modification time at any level below ``path`` in ms; 0 when it is absent."""
        if not self.exists(path):
            return 0
        status = self._fs.getFileStatus(self.path(path))
        latest = status.getModificationTime()
        if status.isDirectory():
            for child in self._fs.listStatus(self.path(path)):
                if not child.getPath().getName().startswith((".", "_")):
                    latest = max(latest, child.getModificationTime())
                    if child.isDirectory():
                        latest = max(latest, self.modified(child.getPath().toString()))
        return latest

    def files(self, path: str) -> list[tuple[str, int]]:
        """All data files below ``path`` with their sizes."""
        if not self.exists(path):
            return []
        found = []
        walk = self._fs.listFiles(self.path(path), True)
        root = self._fs.makeQualified(self.path(path)).toString()
        while walk.hasNext():
            status = walk.next()
            full = status.getPath().toString()
            below = full[len(root):].strip("/").split("/")
            if not any(part.startswith((".", "_")) for part in below):
                found.append((full, status.getLen()))
        return sorted(found)

    def write_text(self, path: str, text: str, overwrite: bool = True) -> None:
        stream = self._fs.create(self.path(path), overwrite)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()

    def read_text(self, path: str) -> str | None:
        if not self.exists(path):
            return None
        stream = self._fs.open(self.path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace_text(self, path: str, text: str) -> None:
        """Write beside the target, then move over it in one rename."""
        staged = f"{path}.next"
        self.write_text(staged, text)
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._fs.getUri(), self._conf
        )
        overwrite = self._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        options = self._jvm.java.lang.reflect.Array.newInstance(overwrite.getClass(), 1)
        self._jvm.java.lang.reflect.Array.set(options, 0, overwrite)
        context.rename(
            self._fs.makeQualified(self.path(staged)),
            self._fs.makeQualified(self.path(path)),
            options,
        )
