"""Account postings: all-or-nothing batches and running balances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weftline.operators.ordered import OrderedGroups
from weftline.session import cut_lineage


def judge_batches(accounts: DataFrame, entries: DataFrame) -> DataFrame:
    """One row per batch: ``posted`` says whether all its entries are applied.

    ``accounts`` has (account, balance), ``entries`` (batch, account, amount). A batch is a candidate when every account in
    it exists and would end at zero or above. Candidates reserve their net debits in the order of ``batch``; one is posted
    when on each account that it debits the opening balance covers all reservations up to and with its own. A refused
    candidate keeps its reservation, so no choice among the posted batches can overdraw an account. Entries are netted per
    batch and account before the join, so a busy account or a huge batch is reduced on the map side.
    """
    net = entries.groupBy("batch", "account").agg(F.sum("amount").alias("delta"), F.count(F.lit(1)).alias("entries"))
    opening = accounts.select(F.col("account").alias("__account"), "balance")
    tested = net.join(opening, F.col("account") == F.col("__account"), "left")
    fits = F.coalesce(F.col("balance") + F.col("delta") >= 0, F.lit(False))
    alone = tested.groupBy("batch").agg(
        F.sum("entries").alias("entries"), F.sum("delta").alias("net"), F.bool_and(fits).alias("__candidate")
    )
    candidates = alone.where("__candidate").select(F.col("batch").alias("__batch"))
    debits = cut_lineage(tested.where("delta < 0").join(candidates, F.col("batch").eqNullSafe(F.col("__batch")), "left_semi"))
    reserved = OrderedGroups(debits, ["account"], ["batch"]).running({"__reserved": ("sum", "delta")}).df
    refused = reserved.where(F.col("balance") + F.col("__reserved") < 0).select(F.col("batch").alias("__batch")).distinct()
    judged = alone.join(refused.withColumn("__refused", F.lit(True)), F.col("batch").eqNullSafe(F.col("__batch")), "left")
    posted = F.col("__candidate") & F.col("__refused").isNull()
    return judged.select("batch", "entries", "net", posted.alias("posted"))


def post_batches(accounts: DataFrame, entries: DataFrame) -> DataFrame:
    """Account balances after all posted batches. An account that starts at zero or above ends there."""
    posted = judge_batches(accounts, entries).where("posted").select(F.col("batch").alias("__batch"))
    applied = entries.join(posted, F.col("batch") == F.col("__batch"), "left_semi")
    deltas = applied.groupBy(F.col("account").alias("__account")).agg(F.sum("amount").alias("__delta"))
    joined = accounts.join(deltas, F.col("account") == F.col("__account"), "left")
    return joined.select("account", (F.col("balance") + F.coalesce("__delta", F.lit(0))).alias("balance"))


def running_balance(
    entries: DataFrame, account: str, order: list[str], amount: Column, opening: Column | None = None,
    out: str = "balance",
) -> DataFrame:
    """Balance of the account after each entry, in order."""
    done = OrderedGroups(entries, [account], order).running({out: ("sum", amount)}).df
    return done if opening is None else done.withColumn(out, F.col(out) + opening)


def first_violation(balances: DataFrame, account: str, order: list[str], balance: str = "balance") -> DataFrame:
    """The first entry per account that leaves it below zero; accounts that never do are not listed."""
    first = F.min_by(F.struct(*order, balance), F.struct(*order)).alias("__first")
    return balances.where(F.col(balance) < 0).groupBy(account).agg(first).select(account, "__first.*")
