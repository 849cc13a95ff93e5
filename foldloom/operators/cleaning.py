"""Cleaning as one tagged pass: every row keeps the first rule that rejects it."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldloom.functions.labels import is_admitted, mapped, mapped_or_kept
from foldloom.functions.numeric import is_bad_number, to_integer, to_number
from foldloom.functions.text import first_item, is_blank, strip, title_and_body
from foldloom.plans.spec import CorpusSpec

# Findings that reject a whole corpus and not only the row; the later one wins.
FATAL = {"not_an_integer": "BAD_LABEL_TYPE", "ragged": "RAGGED"}


def tag_rows(raw: DataFrame, spec: CorpusSpec, with_unmapped: bool = False) -> DataFrame:
    """``(row_id, text, label, reject_reason)`` of all raw rows; the reason is null for good rows.

    ``raw`` holds the columns the spec names as strings and a ``row_id``; a scan may add
    ``fault``, its own reason to reject a row, and ``lacks``, the needed columns that a row does not have, which is kept. ``with_unmapped``
    adds ``unmapped``, the label of a row that has nothing else against it if the spec's vocabulary lacks it.
    """
    text = F.col(spec.text_column)
    if spec.title_column:
        text = title_and_body(F.col(spec.title_column), text)
    if spec.null_text is not None:
        text = F.coalesce(text, F.lit(spec.null_text))
    if spec.strip_text:
        text = strip(text)

    raw_label = F.col(spec.label_column)
    unmapped = F.lit(None).cast("string")
    mapping = dict(spec.labels or {})
    rejects = [("null_text", text.isNull())]
    if spec.drop_blank_text:
        rejects.append(("blank_text", text == ""))
    rejects.append(("null_label", raw_label.isNull()))
    if spec.label_rule == "first_item":
        label = first_item(raw_label)
        rejects.append(("blank_label", label == ""))
    elif spec.label_rule in ("strict_integer", "lenient_integer"):
        number = to_integer(to_number(raw_label))
        reason = "not_an_integer" if spec.label_rule == "strict_integer" else "not_a_number"
        rejects.append((reason, is_bad_number(raw_label)))
        rejects.append(("label_not_admitted", ~is_admitted(number, mapping)))
        label = mapped(number, mapping)
    else:
        label = raw_label
        if spec.admitted is not None:
            rejects.append(("label_not_admitted", ~is_admitted(raw_label, spec.admitted)))
        if mapping:
            unmapped = F.when(~is_admitted(raw_label, mapping), raw_label)
        if mapping and spec.keep_unmapped:
            label = mapped_or_kept(raw_label, mapping)
        elif mapping:
            label = mapped(raw_label, mapping)
            rejects.append(("label_unmapped", label.isNull()))

    reasons = [F.when(condition, F.lit(name)) for name, condition in rejects]
    if "fault" in raw.columns:
        reasons.insert(0, F.col("fault"))
    reason = F.coalesce(*reasons)
    more = [F.col("lacks")] if "lacks" in raw.columns else []
    if with_unmapped:
        more.append(F.when(F.coalesce(reason, F.lit("label_unmapped")) == "label_unmapped", unmapped).alias("unmapped"))
    return raw.select("row_id", text.alias("text"), label.cast("string").alias("label"), reason.alias("reject_reason"), *more)


def kept_rows(tagged: DataFrame) -> DataFrame:
    return tagged.where("reject_reason IS NULL").drop("reject_reason", "lacks", "unmapped")


def reject_report(tagged: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Rows per reason, 'kept' for the good ones: the whole accounting in one aggregate."""
    reason = F.coalesce("reject_reason", F.lit("kept")).alias("reason")
    return tagged.groupBy(*within, reason).agg(F.count("*").alias("n_rows"))


def corpus_gate(tagged: DataFrame, within: Sequence[str] = ("corpus",)) -> DataFrame:
    """One status per corpus: a column that no row has beats a fatal finding beats EMPTY beats OK."""
    reason = F.col("reject_reason")
    status = F.when(F.count_if(reason.isNull()) == 0, "EMPTY").otherwise("OK")
    for name, verdict in FATAL.items():
        status = F.when(F.count_if(reason == name) > 0, verdict).otherwise(status)
    if "lacks" in tagged.columns:
        status = F.when(F.bit_and("lacks") != 0, "MISSING_COLUMNS").otherwise(status)
    return tagged.groupBy(*within).agg(
        F.count("*").alias("rows_in"), F.count_if(reason.isNull()).alias("rows_kept"), status.alias("status")
    )


def drop_failed_corpora(tagged: DataFrame, within: Sequence[str] = ("corpus",)) -> DataFrame:
    """The good rows of those corpora that pass the gate."""
    failed = corpus_gate(tagged, within).where("status <> 'OK'").select(*within)
    # One row per registered corpus at most, so the broadcast is bounded by the registry.
    return kept_rows(tagged).join(F.broadcast(failed), list(within), "left_anti")


def drop_blank(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows whose named columns are neither null nor blank."""
    for name in columns:
        rows = rows.where(~is_blank(F.col(name)))
    return rows
