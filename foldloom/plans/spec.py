"""What makes one corpus differ from another."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from types import MappingProxyType


@dataclass(frozen=True)
class Delimited:
    """Delimited text with a header line."""

    sep: str = ","
    fallback_sep: str | None = None
    quoted: bool = True
    multiline: bool = True
    fallback_encoding: str | None = None


@dataclass(frozen=True)
class JsonLines:
    """One JSON object per line. ``truthy`` drops "", 0, false and [] as it drops null."""

    truthy: bool = False


@dataclass(frozen=True)
class Converted:
    """Parquet made from a format without a Spark source, with its column names kept."""


@dataclass(frozen=True)
class CorpusSpec:
    """A corpus: where text and label come from, how rows are cleaned, and how folds are made.

    label_rule: ``as_is``, ``first_item`` (of a comma list), ``strict_integer`` (a bad value fails the
    corpus) or ``lenient_integer`` (a bad value fails the row). An integer label must be a key of
    ``labels``. For the other rules ``labels`` renames, and ``keep_unmapped`` tells whether labels without
    a new name stay. ``admitted`` is tested before the renaming.
    """

    task: str
    corpus: str
    files: Sequence[str]
    text_column: str
    label_column: str
    source: Delimited | JsonLines | Converted = Delimited()
    title_column: str | None = None
    null_text: str | None = None
    strip_text: bool = False
    drop_blank_text: bool = False
    label_rule: str = "as_is"
    labels: Mapping | None = None
    keep_unmapped: bool = True
    admitted: Sequence[str] | None = None
    fold_rule: str = "contiguous"

    def __post_init__(self):
        if self.labels is not None:
            object.__setattr__(self, "labels", MappingProxyType(dict(self.labels)))

    @property
    def columns(self) -> list[str]:
        named = [self.text_column, self.label_column] + ([self.title_column] if self.title_column else [])
        return list(dict.fromkeys(named))

    @property
    def has_closed_labels(self) -> bool:
        """Whether the number of classes is bounded by the spec itself."""
        if self.label_rule.endswith("_integer") or self.admitted is not None:
            return True
        return bool(self.labels) and not self.keep_unmapped
