"""Fixed-width attestation records: decoding them and judging what they prove."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sourcetrail import contract as K
from sourcetrail.functions.text import fixed, let

# (field, bytes) in storage order
LAYOUT = [
    ("discriminator", 8),
    ("review_id_hash", 32),
    ("input_hash", 32),
    ("analysis_hash", 32),
    ("reviewed_hash", 32),
    ("workflow_version", 32),
    ("model_version", 32),
    ("status", 1),
    ("reviewer", 32),
    ("attested_at", 8),
    ("bump", 1),
]
RECORD_BYTES = sum(width for _, width in LAYOUT)


def id_hash(review_id: Column) -> Column:
    return F.sha2(review_id, 256)


def _slices(data: Column) -> dict[str, Column]:
    start, out = 1, {}
    for name, width in LAYOUT:
        out[name] = F.substring(data, start, width)
        start += width
    return out


def _hash(part: Column) -> Column:
    return F.lower(F.hex(part))


def _padded_text(part: Column) -> Column:
    text = part.cast("string")
    return F.when(F.is_valid_utf8(text), F.regexp_replace(text, r"\x00+$", ""))


def _little_endian_long(part: Column) -> Column:
    digits = F.hex(part)
    swapped = F.concat(*[F.substring(digits, at, 2) for at in range(15, 0, -2)])
    return F.conv(swapped, 16, -10).cast("long")


def _read_fields(data: Column) -> Column:
    parts = _slices(data)
    code = F.conv(F.hex(parts["status"]), 16, 10).cast("int")
    hashes = ("review_id_hash", "input_hash", "analysis_hash", "reviewed_hash")
    return F.struct(
        F.coalesce(F.octet_length(data), F.lit(0)).alias("length"),
        *[_hash(parts[name]).alias(name) for name in hashes],
        _padded_text(parts["workflow_version"]).alias("workflow_version"),
        _padded_text(parts["model_version"]).alias("model_version"),
        F.coalesce(
            F.get(F.array(*[F.lit(s) for s in K.LEDGER_STATUS]), code),
            F.concat(F.lit("UNKNOWN_"), code.cast("string")),
        ).alias("status"),
        _little_endian_long(parts["attested_at"]).alias("attested_at"),
    )


def decode_record(data: Column) -> Column:
    """Struct of the record's fields plus ``error``; every field is NULL where the record is broken."""
    shown = ["review_id_hash", "input_hash", "analysis_hash", "reviewed_hash", "workflow_version", "model_version",
             "status", "attested_at"]

    def judged(read: Column) -> Column:
        too_short = read["length"] < RECORD_BYTES
        no_text = read["workflow_version"].isNull() | read["model_version"].isNull()
        error = F.when(
            too_short, F.format_string(f"record has %d bytes, expected at least {RECORD_BYTES}", read["length"])
        ).when(no_text, F.lit("version text is not UTF-8"))
        return F.struct(*[F.when(~(too_short | no_text), read[n]).alias(n) for n in shown], error.alias("error"))

    return let(_read_fields(data), judged)


def due_for_verification(attestations: DataFrame, verifications: DataFrame) -> DataFrame:
    """Receipts never read, read for another transaction, or read with a failure."""
    last = verifications.select(
        "review_id",
        F.lit(True).alias("__read"),
        F.col("tx_signature").alias("__tx"),
        F.col("error").alias("__error"),
        F.col("tx_confirmed").alias("__confirmed"),
    )
    due = (
        F.col("__read").isNull()
        | (F.col("__tx") != F.col("tx_signature"))
        | F.col("__error").isNotNull()
        | ~F.col("__confirmed")
    )
    return attestations.join(last, "review_id", "left").where(due).select("review_id", "pda_address", "tx_signature")


def verify(
    due: DataFrame, accounts: DataFrame, program_id: str | None = None, verified_at: Column | None = None
) -> DataFrame:
    """Verification events from a snapshot of accounts.

    ``accounts``: pda_address, owner, data, slot; NULL data means the address holds no account.
    ``due`` also says whether the transaction is confirmed, in ``tx_confirmed``."""
    snapshot = accounts.select("pda_address", "owner", "data", "slot")
    read = due.join(snapshot, "pda_address", "left").select("*", fixed(decode_record(F.col("data"))).alias("__record"))
    wrong_owner = F.lit(False) if not program_id else F.col("owner") != program_id
    error = (
        F.when(F.col("data").isNull(), "PDA não encontrada")
        .when(wrong_owner, F.concat(F.lit("owner inesperado: "), F.col("owner")))
        .when(F.col("__record.error").isNotNull(), F.col("__record.error"))
        .when(
            F.col("__record.review_id_hash") != id_hash(F.col("review_id")),
            "review_id_hash on-chain não corresponde ao review_id",
        )
    )
    read = read.withColumn("error", error)
    good = F.col("error").isNull()
    return read.select(
        "review_id",
        "pda_address",
        "tx_signature",
        good.alias("account_found"),
        F.coalesce("tx_confirmed", F.lit(False)).alias("tx_confirmed"),
        *[
            F.when(good, F.col(f"__record.{name}")).alias(f"onchain_{name}")
            for name in ("input_hash", "analysis_hash", "reviewed_hash", "status")
        ],
        "slot",
        "error",
        (F.current_timestamp() if verified_at is None else verified_at).alias("verified_at"),
    )


def on_test_cluster(url: Column, word: str = "devnet") -> Column:
    """True only if the host of the address names the test cluster."""
    return F.coalesce(F.contains(F.lower(F.try_parse_url(url, F.lit("HOST"))), F.lit(word)), F.lit(False))
