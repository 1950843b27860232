"""Mirror a table's folder to another place: new and changed files only, snapshots after data, the pointer last and always."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark.sql import SparkSession

from .files import Files

ORDER = ("schema", "data", "manifest", "snapshot")
_NUMBERED = ("schema", "snapshot")  # a table made anew has these names again, for other content; other names are unique
_COPIES = 16


def pending(spark: SparkSession, source: str, target: str) -> list[str]:
    """Paths below ``source``, however deep, that are missing in ``target``, of another size or (numbered ones) of other content, in the order to copy."""
    files = Files(spark)

    def listed(root: str) -> dict[str, int]:
        """Snapshots are listed first: all that they name is there by then."""
        return {f"{part}/{name}": size for part in reversed(ORDER) for name, size in files.below(f"{root}/{part}")}

    here, there = listed(source), listed(target)
    rest = [p for p in here if not p.endswith("/LATEST")]

    def differs(path: str) -> bool:
        if there.get(path) != here[path]:
            return True
        return path.split("/")[0] in _NUMBERED and files.read_bytes(f"{source}/{path}") != files.read_bytes(f"{target}/{path}")

    with ThreadPool(_COPIES) as pool:
        missing = [p for p, new in zip(rest, pool.map(differs, rest), strict=True) if new]
    return sorted(missing, key=lambda p: (ORDER.index(p.split("/")[0]), p)) + [p for p in here if p.endswith("/LATEST")]


def sync(spark: SparkSession, source: str, target: str) -> list[str]:
    """Copy what is pending, several files of a part at a time. Nothing is deleted on either side: snapshots may still name it."""
    source, target, files = source.rstrip("/"), target.rstrip("/"), Files(spark)
    found = pending(spark, source, target)
    latest = [p for p in found if p.endswith("/LATEST")]
    with ThreadPool(_COPIES) as pool:
        for part in ORDER:
            pool.map(lambda p: files.copy(f"{source}/{p}", f"{target}/{p}"), [p for p in found if p.split("/")[0] == part and p not in latest])
    for path in latest:
        files.copy(f"{source}/{path}", f"{target}/{path}")
    return found
