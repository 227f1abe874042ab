"""What a target table should look like and how a frame is put into it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

MODES = ("overwrite", "append", "merge")
FILE_FORMATS = ("orc", "parquet", "json", "csv")
DEFAULT_FORMAT = "orc"

# The property names of the text option surface.
OPTION_TABLE = "table"
OPTION_MODE = "syncMode"
OPTION_PATH = "externalTablePath"
OPTION_FORMAT = "fileStorageFormat"
OPTION_PARTITIONS = "partitionColumns"
OPTION_DERIVED = "derivedPartitionColumns"
OPTION_BUCKETS = "bucketingColumns"
OPTION_NUM_BUCKETS = "numberOfBuckets"
OPTION_KEYS = "mergeKeys"
OPTION_NUM_PARTITIONS = "numOfRePartitions"


class SpecError(ValueError):
    """The spec is wrong in itself, or does not fit the data or the table."""


@dataclass(frozen=True)
class TableSpec:
    """A sync request.

    ``table`` is ``db.name``. A ``path`` makes the table external. ``derived``
    maps a partition column to the SQL expression that fills it (stored as
    text); derived columns follow ``partition_by`` in the layout. ``None`` for
    ``file_format`` means ORC for a new table and "as it is" for an existing
    one. ``num_partitions`` sets the number of write tasks.

    Merge only: ``keys`` match rows; ``duplicate_keys="error"`` refuses
    repeated keys, the default multiplies them like any join; ``rewrite="all"``
    turns off the rewrite of just the touched partitions; ``rewrite="files"`` also
    keeps, of an orc or parquet table without partitions and buckets, the files that
    hold none of the incoming keys; ``stage_incoming``
    writes the incoming rows once before the several passes over them (turn it
    off only for a frame that is cheap and gives the same rows each time);
    incoming rows of up to ``broadcast_bytes`` in all are broadcast;
    ``file_bytes`` is about how large a csv file gets, which one task must read.
    ``hot_key_rows`` is the row count from which one key is spread over tasks.
    """

    table: str
    mode: str | None = None
    path: str | None = None
    file_format: str | None = None
    partition_by: Sequence[str] = ()
    derived: Mapping[str, str] = field(default_factory=dict)
    bucket_by: Sequence[str] = ()
    num_buckets: int | None = None
    keys: Sequence[str] = ()
    num_partitions: int | None = None
    nested: str = "json"
    duplicate_keys: str = "allow"
    rewrite: str = "touched"
    stage_incoming: bool = True
    broadcast_bytes: int = 64 * 1024 * 1024
    hot_key_rows: int = 1_000_000
    file_bytes: int = 128 * 1024 * 1024

    def __post_init__(self) -> None:
        for name in ("partition_by", "bucket_by", "keys"):
            value = getattr(self, name)
            if isinstance(value, str):
                raise SpecError(f"{name} must be a list of column names")
            object.__setattr__(self, name, tuple(value))
        object.__setattr__(self, "derived", dict(self.derived))
        object.__setattr__(self, "mode", self.mode or "overwrite")
        if self.file_format is not None:
            object.__setattr__(self, "file_format", self.file_format.lower())
        self._validate()

    def _validate(self) -> None:
        if not self.table:
            raise SpecError("table is required")
        _one_of("mode", self.mode, MODES)
        _one_of("file_format", self.file_format, (None, *FILE_FORMATS))
        _one_of("nested", self.nested, ("json", "keep"))
        _one_of("duplicate_keys", self.duplicate_keys, ("allow", "error"))
        _one_of("rewrite", self.rewrite, ("touched", "all", "files"))
        if bool(self.bucket_by) != (self.num_buckets is not None):
            raise SpecError("give both bucket_by and num_buckets, or neither")
        for name in ("num_buckets", "num_partitions", "hot_key_rows", "file_bytes"):
            value = getattr(self, name)
            if value is not None and value < 1:
                raise SpecError(f"{name} must be at least 1, got {value}")
        for name in ("partition_by", "bucket_by", "keys"):
            values = [v.lower() for v in getattr(self, name)]
            if len(set(values)) != len(values):
                raise SpecError(f"{name} names a column twice: {values}")

    @property
    def partition_columns(self) -> tuple[str, ...]:
        """Plain partition columns, then the derived ones."""
        plain = tuple(c for c in self.partition_by if c not in self.derived)
        return plain + tuple(self.derived)

    @property
    def bucket_columns(self) -> tuple[str, ...]:
        """Bucket columns; a column that partitions the table cannot bucket it."""
        return tuple(c for c in self.bucket_by if c not in self.partition_columns)

    def resolved(self, columns: Sequence[str], case_sensitive: bool = False) -> TableSpec:
        """The same spec with every column named as the data names it."""
        taken = [a for a in self.derived if _find(columns, a, case_sensitive)]
        if taken:
            raise SpecError(f"derived columns already in the data: {taken}")

        def named(role: str, names: Sequence[str]) -> tuple[str, ...]:
            found = {n: n if n in self.derived else _find(columns, n, case_sensitive) for n in names}
            missing = [n for n, actual in found.items() if actual is None]
            if missing:
                raise SpecError(f"{role} not in the data: {missing}")
            return tuple(found.values())

        return replace(
            self,
            partition_by=named("partition columns", self.partition_by),
            bucket_by=named("bucket columns", self.bucket_by),
            keys=named("merge keys", self.keys),
        )

    @classmethod
    def from_options(cls, options: Mapping[str, str]) -> TableSpec:
        """Build a spec from text options with comma-separated lists.

        Derived partitions are written ``expression:alias``. Commas inside
        parentheses or quotes and colons inside the expression belong to the expression.
        """

        def items(name: str) -> list[str]:
            return [p.strip() for p in _split_list(options.get(name) or "") if p.strip()]

        def number(name: str) -> int | None:
            return int(options[name]) if options.get(name) else None

        derived = {}
        for item in items(OPTION_DERIVED):
            expression, colon, alias = item.rpartition(":")
            if not colon:
                raise SpecError(f"{OPTION_DERIVED}: expected expression:alias, got {item!r}")
            derived[alias.strip()] = expression.strip()
        return cls(
            table=options.get(OPTION_TABLE) or "",
            mode=options.get(OPTION_MODE),
            path=options.get(OPTION_PATH),
            file_format=options.get(OPTION_FORMAT),
            partition_by=items(OPTION_PARTITIONS),
            derived=derived,
            bucket_by=items(OPTION_BUCKETS),
            num_buckets=number(OPTION_NUM_BUCKETS),
            keys=items(OPTION_KEYS),
            num_partitions=number(OPTION_NUM_PARTITIONS),
        )


def _split_list(text: str) -> list[str]:
    """The parts between commas that stand outside all parentheses and quotes."""
    parts, depth, quoted, start = [], 0, "", 0
    for i, char in enumerate(text):
        if quoted:
            quoted = "" if char == quoted else quoted
        elif char in "'\"`":
            quoted = char
        elif char in "([":
            depth += 1
        elif char in ")]":
            depth -= 1
        elif char == "," and depth <= 0:
            parts.append(text[start:i])
            start = i + 1
    return [*parts, text[start:]]


def _one_of(name: str, value: object, allowed: Sequence[object]) -> None:
    if value not in allowed:
        raise SpecError(f"{name} must be one of {allowed}, got {value!r}")


def _find(columns: Sequence[str], name: str, case_sensitive: bool) -> str | None:
    if name in columns or case_sensitive:
        return name if name in columns else None
    return next((c for c in columns if c.lower() == name.lower()), None)
