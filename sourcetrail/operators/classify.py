"""Classification of findings: what is due, what is sent, and how answers are read.

The classifier itself sits outside; its answers arrive as a column.  A rule-based stand-in answers
in the same format, so a review can run without it."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sourcetrail import contract as K
from sourcetrail.functions.text import fixed, let
from sourcetrail.operators.cdc import answers_complete

FIELDS = {"needs_review": "yes_no", "priority": "choice", "is_clear": "yes_no"}


def question_version(questions: dict, priorities: list[str], prefix: str) -> str:
    """Short fingerprint of the question set; it changes with any question or option."""
    text = json.dumps({"questions": questions, "priorities": priorities}, sort_keys=True, ensure_ascii=False)
    return f"{prefix}-{hashlib.sha256(text.encode()).hexdigest()[:12]}"


def due_for_classification(
    queue: DataFrame, status: DataFrame, version: str, terms: K.Terms = K.DEFAULT_TERMS
) -> DataFrame:
    """Findings of open reviews without an answer, or with an answer to other questions."""
    open_reviews = status.where(~F.col("is_finalized")).select("review_id")
    stale = F.coalesce(F.col(terms.field("prompt_version")), F.lit("")) != version
    due = queue.where((F.col(terms.field("status")) == "PENDING") | stale)
    return due.join(open_reviews, "review_id", "left_semi").select(
        "finding_id", "review_id", "finding_type", "finding_subtype", "summary"
    )


def context_text() -> Column:
    """All the classifier gets to see: no case, review or person."""
    return F.format_string(K.CONTEXT_TEXT, "finding_type", "finding_subtype", "summary")


def request_hash(version: str, model: Column, context: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(version), model, context), 256)


def stand_in_answers(context: Column) -> dict[str, Column]:
    """Deterministic replies in the classifier's own JSON format."""
    risky = F.lit(False)
    for mark in K.RISKY_MARKS:
        risky = risky | F.contains(context, F.lit(mark))
    return {
        "needs_review": F.lit('{"output": true}'),
        "priority": F.when(risky, '{"output": "alta"}').otherwise('{"output": "media"}'),
        "is_clear": F.when(risky, '{"output": false}').otherwise('{"output": true}'),
    }


def _token(reply: Column) -> Column:
    """The answer inside a reply in lower case: bare, under output, or one level deeper.  A key that is there decides,
    also with null, which is no answer."""

    def member(text: Column, names: tuple[str, ...], otherwise: Column) -> Column:
        def chosen(fields: Column) -> Column:
            out = otherwise
            for name in reversed(names):
                out = F.when(F.coalesce(F.map_contains_key(fields, name), F.lit(False)), F.element_at(fields, name)).otherwise(out)
            return out

        # a text without a brace is no object: parsing it would only raise and catch an error, row by row
        return let(F.when(F.contains(text, F.lit("{")), F.from_json(text, "map<string,string>")), chosen)

    def unwrapped(inner: Column) -> Column:
        bare = F.regexp_replace(inner, r'^\s*"(.+)"\s*$', "$1")
        nested = member(inner, ("answer", "value", "choice"), inner)
        return F.lower(F.trim(F.when(F.startswith(F.ltrim(inner), F.lit("{")), nested).otherwise(bare)))

    return let(member(reply, ("output",), reply), unwrapped)


def yes_no(reply: Column) -> Column:
    return let(_token(reply), lambda t: F.when(t.isin(K.YES_TOKENS), True).when(t.isin(K.NO_TOKENS), False))


def choice(reply: Column) -> Column:
    plain = F.replace(_token(reply), F.lit("é"), F.lit("e"))
    return let(plain, lambda t: F.when(t.isin(K.PRIORITIES), t))


def decision_records(
    due: DataFrame,
    replies: dict[str, Column],
    model: str,
    version: str,
    workflow_version: str,
    decided_at: Column | None = None,
    terms: K.Terms = K.DEFAULT_TERMS,
    raw_chars: int | None = None,
) -> DataFrame:
    """One decision event per finding, as the feed expects it.  A missing or odd reply makes the
    record invalid, it never drops it.  Replies are stored whole; ``raw_chars`` cuts them for
    exchange with systems that expect a limit."""
    read = {"yes_no": yes_no, "choice": choice}
    t = terms.field
    asked = due.withColumn("__context", context_text()).withColumns({f"__{k}": r for k, r in replies.items()})
    answers = F.struct(*[read[kind](F.col(f"__{name}")).alias(name) for name, kind in FIELDS.items()])
    answered = asked.select("*", fixed(answers).alias("__answers")).select("*", "__answers.*")
    raw = F.to_json(
        F.struct(*[F.col(f"__{n}").alias(n) if raw_chars is None else F.substring(f"__{n}", 1, raw_chars).alias(n) for n in sorted(FIELDS)])
    )
    complete = answers_complete(F.col("priority"), F.col("needs_review"), F.col("is_clear"))
    return answered.select(
        "finding_id",
        "review_id",
        *FIELDS,
        F.lit(model).alias(t("model")),
        F.lit(version).alias(t("prompt_version")),
        request_hash(version, F.lit(model), F.col("__context")).alias(t("request_hash")),
        raw.alias(t("raw_answers")),
        F.coalesce(complete, F.lit(False)).alias(t("response_valid")),
        F.lit(workflow_version).alias("workflow_version"),
        (F.current_timestamp() if decided_at is None else decided_at).alias("decided_at"),
    )
