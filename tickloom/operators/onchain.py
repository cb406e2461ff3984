"""On-chain transactions: watched addresses, derived columns, invariants, slot order and gaps.

A decoded transaction is a row with static_keys, loaded_writable and
loaded_readonly (arrays of addresses), num_required_signatures, is_vote,
success and instructions (array<struct<program_id_index:int,data:binary>>).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import blocks_lost, role_rank
from tickloom.operators import blocked

# The program that sets compute budgets, and its two instruction kinds.
COMPUTE_BUDGET = "ComputeBudget111111111111111111111111111111"
SET_LIMIT, SET_PRICE = 2, 3

def account_keys() -> Column:
    return F.concat("static_keys", "loaded_writable", "loaded_readonly")


def signer_count() -> Column:
    return F.least(F.col("num_required_signatures"), F.size("static_keys"))


def signers() -> Column:
    return F.slice("static_keys", 1, signer_count())


def version(config: Column, versioned: Column) -> Column:
    return F.when(config, "v1").when(versioned, "v0").otherwise("legacy")


def _keys(rows: DataFrame) -> DataFrame:
    """A row for each key of a transaction: its columns, address and rank (2 fee payer, 1 signer, 0 any other)."""
    n = signer_count()
    static = F.transform("static_keys", lambda x, k: F.struct(x.alias("address"), F.when((k == 0) & (n > 0), 2).when(k < n, 1).otherwise(0).alias("rank")))
    loaded = F.transform(F.concat("loaded_writable", "loaded_readonly"), lambda x: F.struct(x.alias("address"), F.lit(0).alias("rank")))
    return rows.withColumn("_key", F.explode(F.concat(static, loaded))).withColumns({"address": F.col("_key.address"), "rank": F.col("_key.rank")}).drop("_key")


def _role() -> Column:
    return F.when(F.col("rank") == 2, "fee_payer").when(F.col("rank") == 1, "signer").otherwise("account_key")


def roles(transactions: DataFrame, key: Sequence[str] = ("signature",)) -> DataFrame:
    """(key, address, role): each address of a transaction with its strongest role."""
    return _keys(transactions).groupBy(*key, "address").agg(F.max("rank").alias("rank")).select(*key, "address", _role().alias("match_role"))


def matched(transactions: DataFrame, watch: DataFrame, key: Sequence[str] = ("signature",)) -> DataFrame:
    """A row for each transaction and watched address that it matches.

    ``watch``: address, required_role, include_failed, keep_logs. Votes never
    match; failed transactions only where asked for; the role must be at least
    the required one. The keys meet the watch list before anything is
    shuffled (Catalyst broadcasts the list while its size allows that), so only
    matches are grouped; the transactions are read once.
    """
    asked = ("required_role", "include_failed", "keep_logs")
    met = _keys(transactions.where("not is_vote")).join(watch.select("address", *asked), "address").where("success or include_failed")
    rest = [c for c in transactions.columns if c not in (*key, "address")]
    # Rows that share a key but differ elsewhere are different transactions: none stands for another.
    best = met.groupBy(*key, "address", *asked, *rest).agg(F.max("rank").alias("rank"))
    out = best.withColumn("match_role", _role()).where(role_rank(F.col("match_role")) >= role_rank(F.col("required_role")))
    if "log_messages" in transactions.columns:
        out = out.withColumn("log_messages", F.when(F.col("keep_logs"), F.col("log_messages")))
    return out.select(*transactions.columns, "address", "match_role")


#: Bytes of a signature and of an account key.
SIGNATURE_BYTES, KEY_BYTES = 64, 32
# Kinds of updates that no subscription here asks for.
UNREQUESTED = ("account", "slot", "transaction_status", "block", "entry", "block_footer", "entry_update_parent")


def told_updates(updates: DataFrame) -> DataFrame:
    """Stream updates with ``kind`` (transaction, block_meta, ping, pong or unrequested), ``what`` (of an unrequested one: which) and ``fault``.

    An update is a row with one of the columns set, each a struct as the wire
    message nests it (a protobuf reader gives these): ``transaction`` holds
    slot, bank_id and transaction{signature, transaction{message{header,
    account_keys}}, meta{loaded_writable_addresses, loaded_readonly_addresses,
    log_messages, log_messages_none}}. ``fault`` names what a transaction lacks,
    by its path, or which of its byte fields has a wrong length; null if it can
    be read. Columns that the frame lacks count as not set.
    """
    there = set(updates.columns)

    def given(name: str) -> Column:
        return F.col(name).isNotNull() if name in there else F.lit(False)

    unrequested = F.coalesce(*(F.when(given(n), n) for n in UNREQUESTED), F.lit("empty"))
    known = ("transaction", "block_meta", "ping", "pong")
    kind = F.coalesce(*(F.when(given(n), n) for n in known), F.lit("unrequested"))
    told = updates.withColumn("kind", kind).withColumn("what", F.when(F.col("kind") == "unrequested", unrequested))
    if "transaction" not in there:
        return told.withColumn("fault", F.lit(None).cast("string"))
    info = F.col("transaction.transaction")
    body = info["transaction"]

    def missing(value: Column, path: str) -> Column:
        return F.when(value.isNull(), f"missing {path}")

    def odd_key(keys: Column, name: str) -> Column:
        at = F.get(F.filter(F.transform(keys, lambda x, k: F.when(F.coalesce(F.octet_length(x), F.lit(0)) != KEY_BYTES, k)), lambda k: k.isNotNull()), 0)
        return F.when(at.isNotNull(), F.concat(F.lit(f"{name}["), at, F.lit("]")))

    length = F.coalesce(F.octet_length(info["signature"]), F.lit(0))
    fault = F.coalesce(
        missing(info, "transaction"),
        F.when(length != SIGNATURE_BYTES, F.concat(F.lit("signature of "), length, F.lit(" bytes"))),
        missing(body, "transaction.transaction"),
        missing(body["message"], "transaction.transaction.message"),
        missing(body["message"]["header"], "transaction.transaction.message.header"),
        missing(info["meta"], "transaction.meta"),
        odd_key(body["message"]["account_keys"], "account_keys"),
        odd_key(info["meta"]["loaded_writable_addresses"], "loaded_writable_addresses"),
        odd_key(info["meta"]["loaded_readonly_addresses"], "loaded_readonly_addresses"),
    )
    return told.withColumn("fault", F.when(F.col("kind") == "transaction", fault))


def logs(meta: Column) -> Column:
    """A transaction's log lines; null where the node kept none, which isn't the same as no line."""
    return F.when(~F.coalesce(meta["log_messages_none"], F.lit(False)), F.coalesce(meta["log_messages"], F.array().cast("array<string>")))


def _number(data: Column, size: int) -> Column:
    """Little-endian bytes after the kind byte as a number; null if there are too few."""
    body = F.substring(data, 2, size)
    return F.when(F.octet_length(data) > size, F.conv(F.hex(_reversed(body, size)), 16, 10).cast("decimal(20,0)"))


def _reversed(data: Column, size: int) -> Column:
    return F.concat(*(F.substring(data, k, 1) for k in range(size, 0, -1)))


def requested_compute(transactions: DataFrame) -> DataFrame:
    """With compute_unit_limit and compute_unit_price_micro_lamports, from the first well-formed instruction of each kind."""
    keys = account_keys()

    def first(kind: int, size: int) -> Column:
        own = F.filter("instructions", lambda i: (F.try_element_at(keys, i["program_id_index"] + 1) == COMPUTE_BUDGET) & (F.conv(F.hex(F.substring(i["data"], 1, 1)), 16, 10).cast("int") == kind) & (F.octet_length(i["data"]) > size))
        return _number(F.get(own, 0)["data"], size)

    return transactions.withColumn("compute_unit_limit", first(SET_LIMIT, 4).cast("long")).withColumn("compute_unit_price_micro_lamports", first(SET_PRICE, 8))


# A base58 address of 32 bytes has 32 to 44 characters of the alphabet.
FAILED_LOG = r"^Program ([1-9A-HJ-NP-Za-km-z]{32,44}) failed: (?s)(.*)$"


def failure_log(logs: Column) -> Column:
    """struct(program_id, message) of the first log line that tells a program's failure, or null."""
    line = F.get(F.filter(logs, lambda x: x.rlike(FAILED_LOG)), 0)
    return F.when(line.isNotNull(), F.struct(F.regexp_extract(line, FAILED_LOG, 1).alias("program_id"), F.regexp_extract(line, FAILED_LOG, 2).alias("message")))


def raw_error(raw: Column) -> Column:
    return F.concat(F.lit("0x"), F.lower(F.hex(raw)))


def violation() -> Column:
    """The first invariant that a transaction row breaks, or null."""
    c = F.col
    failed = c("failure_error").isNotNull()
    return (
        F.when(F.coalesce(c("signature"), F.lit("")) == "", "signature")
        .when(F.coalesce(c("source_tx_ts_us"), F.lit(0)) == 0, "source_tx_ts_us")
        .when(F.coalesce(c("blockhash"), F.lit("")) == "", "blockhash")
        .when(F.coalesce(c("block_height"), F.lit(0)) == 0, "block_height")
        .when(c("success") == failed, "failure")
        .when(c("failure_error") == "", "failure.error")
        .when((c("version") == "v1") & c("compute_unit_price_micro_lamports").isNotNull(), "compute_unit_price_micro_lamports")
        .when((c("version") != "v1") & c("priority_fee_lamports").isNotNull(), "priority_fee_lamports")
    )


def invariants(rows: DataFrame) -> DataFrame:
    """How many rows break each invariant."""
    return rows.select(violation().alias("rule")).where("rule is not null").groupBy("rule").agg(F.count("*").alias("n"))


def out_of_order(rows: DataFrame, order: Sequence[str], by: Sequence[str] = ("address",)) -> DataFrame:
    """(by, out_of_order): rows whose (slot, tx_index) doesn't lie beyond the row before."""
    at = F.struct("slot", "tx_index")
    told = blocked.scanned(rows.select(*dict.fromkeys([*by, *order, "slot", "tx_index"])), by, order, {"_last": ("lag", at)})
    return told.select(*by, F.coalesce(at <= F.col("_last"), F.lit(False)).alias("bad")).groupBy(*by).agg(F.count(F.when(F.col("bad"), 1)).alias("out_of_order"))


def repeated_across(rows: DataFrame, file: str = "file", key: Sequence[str] = ("day", "address", "signature")) -> DataFrame:
    """Keys that stand in several files of a day (repeats inside one file don't count)."""
    return rows.groupBy(*key).agg(F.countDistinct(file).alias("files")).where("files > 1")


def slot_gaps(metas: DataFrame, key: Sequence[str] = (), order: str = "block_height") -> DataFrame:
    """Jumps in block height: (prev_slot, prev_height, next_slot, next_height, blocks_lost).

    A chain is one sequence. To keep its window from one task, heights are
    first reduced to the ends of ranges of 65536; a jump inside a range is
    found there, a jump between ranges by the ranges' ends.
    """
    step = 1 << 16
    rows = metas.select(*key, "slot", F.col(order).alias("h")).where("h is not null").withColumn("part", F.expr(f"h div {step}"))
    inside = Window.partitionBy(*key, "part").orderBy("h", "slot")
    jumps = rows.select(*key, F.lag("slot").over(inside).alias("prev_slot"), F.lag("h").over(inside).alias("prev_height"), F.col("slot").alias("next_slot"), F.col("h").alias("next_height"))
    ends = rows.groupBy(*key, "part").agg(F.min(F.struct("h", "slot")).alias("first"), F.max(F.struct("h", "slot")).alias("last"))
    over = (Window.partitionBy(*key) if key else Window.partitionBy(F.lit(0))).orderBy("part")
    between = ends.select(*key, F.lag("last").over(over).alias("a"), F.col("first").alias("b")).select(
        *key, F.col("a.slot").alias("prev_slot"), F.col("a.h").alias("prev_height"), F.col("b.slot").alias("next_slot"), F.col("b.h").alias("next_height")
    )
    both = jumps.unionByName(between).where("next_height > prev_height + 1")
    return both.withColumn("blocks_lost", blocks_lost(F.col("prev_height"), F.col("next_height")))


def complete(columns: Sequence[str]) -> Column:
    """Whether a block meta has a height, a time and a blockhash; of a frame that lacks one of the columns, only the others are told."""
    c = F.col
    parts = {"block_height": c("block_height") > 0, "block_time_secs": c("block_time_secs") > 0, "blockhash": c("blockhash") != ""}
    return F.coalesce(reduce(and_, (own for name, own in parts.items() if name in columns), F.lit(True)), F.lit(False))


def sealed(transactions: DataFrame, metas: DataFrame, key: Sequence[str] = ("slot", "bank_id"), undecodable: DataFrame | None = None) -> DataFrame:
    """Transactions of blocks whose meta arrived, with the block's context.

    A bank is discarded with its transactions where its meta lacks height, time
    or blockhash, or where one of its updates is in ``undecodable`` (key).
    Metas told by ``verdicts`` count only where they are sealed; without a
    verdict the order of arrival (late, abandoned, uncovered) is not known.
    """
    if "verdict" in metas.columns:
        metas = metas.where("verdict = 'sealed'")
    context = metas.where(complete(metas.columns)).select(*key, "block_height", "block_time_secs", "blockhash").dropDuplicates(list(key))
    if undecodable is not None:
        context = context.join(undecodable.select(*key), list(key), "left_anti")
    return transactions.join(context, list(key)).withColumn("source_tx_ts_us", F.col("block_time_secs") * 1_000_000)


#: Slots between what was seen first and the first slot that counts as covered in full.
COVERAGE_MARGIN = 2


def verdicts(metas: DataFrame, reorder: int = 4, abandon: int = 32, order: str = "arrival", updates: DataFrame | None = None, covered_from: int | str | None = None) -> DataFrame:
    """Metas with a verdict, the first of these that holds:

    uncovered (its slot lies before the coverage), duplicate (a meta of its
    bank was taken before), abandoned (more than ``abandon`` slots behind),
    partial (no height, time or blockhash), late (more than ``reorder`` slots
    behind, so that newer heights were released), duplicate (its height is
    sealed already), partial (an update of its bank before it could not be
    decoded), else sealed. A bank is remembered for twice ``abandon`` slots.

    ``order`` is a number that rises with arrival, also through ``updates``
    (slot, bank_id, order, undecodable): the transactions and undecodable
    updates between the metas, which raise the highest slot too.
    ``covered_from``: the first covered slot, "first" for a margin after the
    slot that arrived first, None if everything is covered. Coverage is one
    stretch; the streaming version opens and closes it.
    """
    names = metas.columns
    rows = metas.withColumn("_meta", F.lit(True)).withColumn("_bad", F.lit(False))
    if updates is not None:
        others = updates.select("slot", "bank_id", order, F.lit(False).alias("_meta"), F.coalesce("undecodable", F.lit(False)).alias("_bad"))
        rows = rows.unionByName(others, allowMissingColumns=True)
    if covered_from == "first":
        first = rows.agg(F.min_by("slot", order)).first()[0]
        covered_from = None if first is None else first + COVERAGE_MARGIN
    # The highest slot so far, in blocks of arrivals, so that no task orders the whole chain.
    rows = blocked.scanned(rows, (), [order], {"_top": ("max", F.col("slot"))}, width=blocked.NUMBERS)
    behind = F.coalesce(F.col("_top") - F.col("slot"), F.lit(0))
    covered = F.lit(True) if covered_from is None else F.col("slot") >= covered_from
    bank = Window.partitionBy("slot", "bank_id")
    at = F.col(order)
    rows = rows.withColumn("_behind", behind).withColumn("_covered", covered)
    rows = rows.withColumn("_taken", F.min(F.when(F.col("_meta") & F.col("_covered") & (F.col("_behind") <= abandon), at)).over(bank)).withColumn("_bad", F.coalesce(F.min(F.when(F.col("_bad"), at)).over(bank) < at, F.lit(False)))
    early = (
        F.when(~F.col("_covered"), "uncovered")
        .when((F.col("_taken") < at) & (F.col("_behind") <= 2 * abandon), "duplicate")
        .when(F.col("_behind") > abandon, "abandoned")
        .when(~complete(names), "partial")
        .when(F.col("_behind") > reorder, "late")
    )
    rows = rows.where("_meta").withColumn("_early", early)
    # One height is sealed once; rows told already stand alone.
    height = Window.partitionBy(F.when(F.col("_early").isNull(), F.col("block_height")), F.when(F.col("_early").isNotNull(), at))
    rows = rows.withColumn("_first", F.min(F.when(~F.col("_bad"), at)).over(height))
    verdict = F.coalesce("_early", F.when(F.col("_first") < at, "duplicate").when(F.col("_bad"), "partial").otherwise("sealed"))
    return rows.select(*names, verdict.alias("verdict"))


def slot_ticks(metas: DataFrame) -> DataFrame:
    """The chain's own clock: one tick for each sealed slot with a time."""
    return metas.where("block_time_secs is not null").groupBy("slot").agg(F.min("block_time_secs").alias("t")).select("slot", (F.col("t") * 1_000_000).alias("ts_us"))
