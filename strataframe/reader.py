"""Random access to the frames of one archive of a store."""

from __future__ import annotations

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from strataframe.operators import container


class ArchiveReader:
    """``reader[i]``, ``reader[a:b:c]``, ``frame(i)``: frames in acquisition order (storage order where none is known)."""

    def __init__(self, spark: SparkSession, folder: str, archive: str):
        self.spark, self.folder, self.archive = spark, folder, archive
        found = container.archives(spark, folder).where(F.col("archive") == archive).first()
        if found is None:
            raise KeyError(archive)
        self.meta = found.asDict(recursive=True)
        self.by = "acq_idx" if self.meta["temporal_order_known"] else "storage_idx"

    def __len__(self) -> int:
        return self.meta["n_frames"]

    @property
    def shape(self) -> tuple[int, int, int]:
        return len(self), self.meta["rows"], self.meta["cols"]

    def _get(self, indices: list[int], by: str) -> list[np.ndarray]:
        """Frames in the order of ``indices``, which may repeat."""
        if not indices:
            return []
        if min(indices) < 0 or max(indices) >= len(self):
            raise IndexError(f"frames are numbered 0 to {len(self) - 1}")
        wanted = sorted(set(indices))
        low = f"{container.literal('archive', self.archive)} and {by} between {wanted[0]} and {wanted[-1]}"
        rows = container.frames(self.spark, self.folder, f"{low} and {by} in ({','.join(map(str, wanted))})")
        found = {r[by]: np.frombuffer(bytes(r["pixels"]), "<u2").reshape(r["rows"], r["cols"]) for r in rows.toLocalIterator()}
        return [found[i] for i in indices]

    def frame(self, i: int) -> np.ndarray:
        return self._get([i], self.by)[0]

    def frame_by_storage_index(self, i: int) -> np.ndarray:
        return self._get([i], "storage_idx")[0]

    def frames(self, indices) -> np.ndarray:
        got = self._get(list(indices), self.by)
        return np.stack(got) if got else np.empty((0, *self.shape[1:]), np.uint16)

    def __getitem__(self, key):
        if isinstance(key, slice):
            return self.frames(range(*key.indices(len(self))))
        return self.frame(int(key))

    def member_name(self, i: int) -> str:
        if not 0 <= i < len(self):
            raise IndexError(i)
        rows = container.part(self.spark, self.folder, "entries")
        return rows.where((F.col("archive") == self.archive) & (F.col(self.by) == i)).first()["name"]
