from pyspark.sql import functions as F
from samples import bag

from weftline.operators import ledger


def accounts(spark, *balances):
    return spark.createDataFrame([(i + 1, b) for i, b in enumerate(balances)], "account int, balance int")


def entries(spark, *rows):
    return spark.createDataFrame(list(rows), "batch string, account int, amount int")


def test_a_transfer_is_posted(spark):
    after = ledger.post_batches(accounts(spark, 100, 50), entries(spark, ("t", 1, -30), ("t", 2, 30)))
    assert bag(after) == [(1, 70), (2, 80)]


def test_an_overdraft_undoes_its_whole_batch_only(spark):
    books = entries(spark, ("big", 1, -200), ("big", 2, 200), ("ok", 1, -10), ("ok", 2, 10), ("ghost", 9, 5), ("ghost", 1, -5))
    judged = ledger.judge_batches(accounts(spark, 70, 80), books)
    assert bag(judged, "batch", "net", "posted") == [("big", 0, False), ("ghost", 0, False), ("ok", 0, True)]
    assert bag(ledger.post_batches(accounts(spark, 70, 80), books)) == [(1, 60), (2, 90)]


def test_entries_of_a_batch_are_netted(spark):
    books = entries(spark, ("b", 1, -100), ("b", 1, 40), ("b", 2, 60))
    assert bag(ledger.post_batches(accounts(spark, 60, 0), books)) == [(1, 0), (2, 60)]


def test_running_balance_and_first_violation(spark):
    moves = spark.createDataFrame(
        [("a", 1, 50), ("a", 2, -80), ("a", 3, 100), ("a", 4, -200), ("b", 1, 5)], "account string, seq int, amount int"
    )
    done = ledger.running_balance(moves, "account", ["seq"], F.col("amount"))
    assert bag(done, "account", "seq", "balance") == [("a", 1, 50), ("a", 2, -30), ("a", 3, 70), ("a", 4, -130), ("b", 1, 5)]
    assert bag(ledger.first_violation(done, "account", ["seq"])) == [("a", 2, -30)]
    opened = ledger.running_balance(moves, "account", ["seq"], F.col("amount"), opening=F.lit(30))
    assert bag(ledger.first_violation(opened, "account", ["seq"])) == [("a", 4, -100)]


def test_batches_cannot_overdraw_an_account_together(spark):
    books = entries(spark, ("a", 1, -80), ("a", 2, 80), ("b", 1, -80), ("b", 2, 80), ("c", 1, -20), ("c", 2, 20))
    judged = ledger.judge_batches(accounts(spark, 100, 0), books)
    # c is refused too: the refused b keeps its reservation, so the answer does not depend on who is judged first.
    assert bag(judged, "batch", "posted") == [("a", True), ("b", False), ("c", False)]
    assert bag(ledger.post_batches(accounts(spark, 100, 0), books)) == [(1, 20), (2, 80)]
