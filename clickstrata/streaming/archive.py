"""Finished files leave the feed, so that neither its listing nor what a stream remembers grows.

A batch's files are noted before the batch counts as finished, and moved into the archive,
under the same folders, once it is. When all noted files have been moved, whatever is left in
the feed is new, and the next run begins an epoch: a checkpoint of its own that remembers no
file. Batches are numbered on from epoch to epoch. A run that died is first made good within
its epoch, so no file is taken in twice and none is lost, however old its folder or time.
Files without lines, and those before the cutoff, stay where they are, and are looked at again
by each epoch, which may give an empty batch.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from clickstrata.sources.marks import children, file_system, names, remove

_EPOCH = "epoch"


class Archive:
    """The archive of a feed, with notes and epochs kept under a checkpoint folder."""

    def __init__(self, spark: SparkSession, feed: str, folder: str, checkpoint: str):
        self.spark, self.checkpoint, self.notes = spark, checkpoint, f"{checkpoint}/files"
        self.feed, self.files = file_system(spark, feed)
        self.feed = self.files.makeQualified(self.feed)
        self.folder = self.files.makeQualified(file_system(spark, folder)[0])
        if f"{self.folder.toString()}/".startswith(f"{self.feed.toString()}/"):
            raise ValueError("the archive must lie outside the feed")

    def epoch(self, committed: int) -> tuple[str, int]:
        """The checkpoint to run under, and the number of its first batch."""
        epochs = children(self.spark, self.checkpoint, _EPOCH)
        if epochs and (names(self.spark, self.notes) or self._unfinished(epochs[-1])):
            first = epochs[-1]
        else:
            first = committed + 1
            for old in epochs:
                if old < first:
                    remove(self.spark, f"{self.checkpoint}/{_EPOCH}={old}")
        return f"{self.checkpoint}/{_EPOCH}={first}", first

    def _unfinished(self, epoch: int) -> bool:
        """Whether a batch was begun in an epoch and not noted as done by the stream."""
        place = f"{self.checkpoint}/{_EPOCH}={epoch}"
        begun, done = ({*names(self.spark, f"{place}/{log}")} for log in ("offsets", "commits"))
        return bool({n for n in begun if n.isdigit()} - done)

    def note(self, number: int, files: list[str]) -> None:
        """Remember a batch's files, given as Spark names them."""
        path, store = file_system(self.spark, f"{self.notes}/{number}")
        out = store.create(path, True)
        out.write(bytearray("\n".join(files).encode()))
        out.close()

    def move(self, committed: int) -> None:
        """Move the files of finished batches, also those that a dead run left."""
        for name in sorted(names(self.spark, self.notes), key=int):
            if int(name) <= committed:
                note = f"{self.notes}/{name}"
                for line in self.spark.read.text(note).collect():
                    self._move(line.value)
                remove(self.spark, note)

    def _move(self, file: str) -> None:
        jvm = self.spark._jvm
        source = self.files.makeQualified(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file)))
        if not self.files.exists(source):
            return
        inside = source.toString().removeprefix(f"{self.feed.toString()}/")
        target = jvm.org.apache.hadoop.fs.Path(self.folder, inside)
        self.files.mkdirs(target.getParent())
        if self.files.exists(target):
            # A second file of that name, which came after the first had been moved.
            self.files.delete(target, False)
        self.files.rename(source, target)
        folder = source.getParent()
        while not folder.equals(self.feed) and not self.files.listStatus(folder):
            self.files.delete(folder, False)
            folder = folder.getParent()
