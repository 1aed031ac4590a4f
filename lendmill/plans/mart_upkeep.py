"""Both marts kept up by what changed: sums per key move by signed rows, touched buckets are rewritten.

What is kept, each in buckets of its key:

    loan_rows      every loan row that counts, with how often it does
    loans_now      the newest of each loan
    repay_sums     per loan: installments, due, paid, late
    repay_days     per loan and days late: rows, for the worst
    customer_rows  every customer row that counts
    customers_now  the newest of each customer
    account_rows   account, owner, rows
    txn_sums       per account: transactions and their amount
    customer_sums  per customer: loans, savings and transactions
    customer_flags per customer and default flag: loans, for the worst
    mart_*         the marts, under the gold layer

A change reads what came and went, and of each table the buckets that its keys fall into; those
are rewritten whole, so what follows from other tables is made again for the whole bucket, without
telling touched keys from others. An account's transactions belong to whoever owns it: where either
changes, what the accounts of its bucket gave to their owners before is taken back and what they
give now is added, which leaves nothing of an account that did not change. Age depends on
the day, so the customer mart keeps the date of birth and tells the age when it is read.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lendmill.functions.cleaning import safe_ratio, years_between
from lendmill.operators import increments as I
from lendmill.operators import staging as S
from lendmill.operators.history import latest_per_key
from lendmill.operators.increments import SIGN
from lendmill.operators.relations import union_all, zero_filled
from lendmill.plans.marts import mart_customer_360, mart_loan_performance
from lendmill.sources.buckets import BUCKETS, BucketTable, side_by_side
from lendmill.sources.warehouse import target_path

#: Of the rows of one loan or customer the newest counts; the whole row decides between equal times.
NEWEST = ("updated_at", "_loaded_at")

_CUSTOMER = ("customer_id", "full_name", "segment", "province", "city", "birth_date", "credit_score", "monthly_income")

_LOAN_SUMS = {"total_plafond": "plafond", "total_outstanding": "outstanding"}
_SUMS = ("total_plafond", "total_outstanding", "total_savings_balance", "total_txn_amount")
_COUNTS = ("n_loans", "n_savings_accounts", "n_transactions")


def newest_rows(rows: DataFrame, key: str) -> DataFrame:
    """The newest row of each key, whatever order rows come in.

    Only rows of the newest time of their key are written out whole, after the shuffle.
    """
    of_key = W.partitionBy(key)
    newest = F.rank().over(of_key.orderBy(*[F.col(c).desc_nulls_last() for c in NEWEST]))
    newest = rows.withColumn("_place", newest).filter("_place = 1").drop("_place")
    whole = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    return latest_per_key(newest.withColumn("_whole", whole), key, "_whole").drop("_whole")


class MartUpkeep:
    """The kept tables of a lakehouse, and the changes made to them.

    ``raw`` names the raw tables with the columns that come in; only their schemas are used.
    """

    def __init__(self, spark: SparkSession, root: str, raw: dict[str, DataFrame], buckets: int = BUCKETS):
        self.spark, self.root, self.buckets = spark, root, buckets
        self._raw = {n: df.limit(0) for n, df in raw.items()}
        # what is kept of nothing says which columns and types the tables have
        none = {n: I.signed(df) for n, df in self._raw.items()}
        loans = I.signed(self._raw["raw_loans"])
        staged = {n: self._staged(n, df) for n, df in none.items()}
        self.loan_rows = self._table("loan_rows", "loan_id", I.counted(loans))
        self.loans_now = self._table("loans_now", "loan_id", self._raw["raw_loans"])
        self.repay_sums = self._table("repay_sums", "loan_id", self._repay_sums(staged["raw_repayments"]))
        days = I.signed_values(staged["raw_repayments"], "loan_id", "days_late")
        self.repay_days = self._table("repay_days", "loan_id", days)
        customers = I.counted(none["raw_customers"])
        self.customer_rows = self._table("customer_rows", "customer_id", customers)
        self.customers_now = self._table("customers_now", "customer_id", self._raw["raw_customers"])
        accounts = I.counted(self._accounts(staged["raw_savings"]))
        self.account_rows = self._table("account_rows", "account_id", accounts)
        txn = I.signed_sums(staged["raw_transactions"], "account_id", {"amount": "amount"})
        self.txn_sums = self._table("txn_sums", "account_id", txn)
        gains = self._customer_gains(loans, staged["raw_savings"], self._account_gains(accounts, txn))
        self.customer_sums = self._table("customer_sums", "customer_id", gains)
        flags = I.signed_values(_with_id(loans), "customer_id", "is_default")
        self.customer_flags = self._table("customer_flags", "customer_id", flags)
        self._loan_mart_like = mart_loan_performance(
            S.stg_loans(self._raw["raw_loans"]), S.stg_repayments(self._raw["raw_repayments"])
        )
        self._customer_mart_like = mart_customer_360(
            S.stg_customers(self._raw["raw_customers"], "2000-01-01"),
            S.stg_loans(self._raw["raw_loans"]),
            S.stg_savings(self._raw["raw_savings"]),
            S.stg_transactions(self._raw["raw_transactions"]),
        )
        self.loan_mart_table = self._table("mart_loan_performance", "loan_id", self._loan_mart_like, "gold")
        customer_mart = self._customer_mart_like.withColumn("birth_date", F.lit(None).cast("date")).drop("age")
        self.customer_mart_table = self._table("mart_customer_360", "customer_id", customer_mart, "gold")

    def _table(self, name: str, key: str, like: DataFrame, layer: str = "silver") -> BucketTable:
        path = target_path(self.root, name, layer)
        return BucketTable(self.spark, path, key, like.schema, self.buckets)

    # ---- what rows give ---------------------------------------------------------

    @staticmethod
    def _staged(name: str, rows: DataFrame) -> DataFrame:
        """Signed raw rows as signed staged rows; loans and customers are kept raw."""
        if name in ("raw_loans", "raw_customers"):
            return rows
        stage: Callable[[DataFrame], DataFrame] = getattr(S, name.replace("raw_", "stg_"))
        return I.signed(stage(rows.filter(f"{SIGN} > 0")), stage(rows.filter(f"{SIGN} < 0")))

    @staticmethod
    def _repay_sums(rows: DataFrame) -> DataFrame:
        sums = {"total_due": "amount_due", "total_paid": "amount_paid", "n_late": "is_late"}
        return I.signed_terms(rows, "loan_id", sums)

    @staticmethod
    def _accounts(rows: DataFrame) -> DataFrame:
        return rows.select("account_id", "customer_id", SIGN)

    @staticmethod
    def _account_gains(accounts: DataFrame, txn: DataFrame) -> DataFrame:
        """What accounts give to their owners."""
        owned = accounts.withColumnRenamed("n_rows", "_owners").join(txn, "account_id")
        return owned.filter(F.col("customer_id").isNotNull()).select(
            "customer_id",
            (F.col("n_rows") * F.col("_owners")).alias("n_transactions"),
            (F.col("amount") * F.col("_owners").cast("decimal(18,0)")).alias("total_txn_amount"),
            (F.col("amount__n") * F.col("_owners")).alias("total_txn_amount__n"),
        )

    @staticmethod
    def _customer_gains(loans: DataFrame, savings: DataFrame, accounts: DataFrame) -> DataFrame:
        """Loans, savings and transactions in one grouped pass; ``n_rows`` counts what is behind a row."""
        owed = I.signed_sums(_with_id(loans), "customer_id", _LOAN_SUMS)
        owed = owed.withColumn("n_loans", F.col("n_rows"))
        saved = I.signed_sums(savings, "customer_id", {"total_savings_balance": "balance"})
        saved = saved.withColumn("n_savings_accounts", F.col("n_rows"))
        accounts = accounts.withColumn("n_rows", F.col("n_transactions"))
        rows = owed.unionByName(saved, True).unionByName(accounts, True)
        kinds = dict(rows.dtypes)
        columns = ["n_rows", *_COUNTS, *[x for s in _SUMS for x in (s, f"{s}__n")]]
        return rows.groupBy("customer_id").agg(
            *[
                F.coalesce(F.sum(c), F.lit(0)).cast(I.wide(kinds[c])).alias(c)
                for c in columns
            ]
        )

    # ---- a change ---------------------------------------------------------------

    def apply(self, changes: dict[str, tuple[DataFrame, DataFrame | None]], number: int) -> None:
        """Make a numbered change: per raw table the rows that came and those that went.

        Numbers rise. A change that died half-way is made again under its number and with
        the same rows: tables that have it already are left as they are.
        """
        if not changes:
            return
        raw = {n: I.signed(came, gone) for n, (came, gone) in changes.items()}
        staged = {n: self._staged(n, rows) for n, rows in raw.items()}

        def delta(name: str, fn: Callable[[DataFrame], DataFrame]) -> DataFrame | None:
            return fn(staged[name]) if name in staged else None

        # everything below is made anew by whole buckets, so the touched buckets are all there is to know
        only = self._touched(raw)
        steps: list[Callable[[], object]] = []

        def merge(table: BucketTable, rows: DataFrame | None, name: str, *same: str) -> None:
            if rows is not None:
                steps.append(lambda: table.merge(only[name], number, rows, *same))

        for table in (self.loan_rows, self.customer_rows):
            name = self._source(table)
            if name in raw:
                known = raw[name].filter(F.col(table.key).isNotNull())
                merge(table, I.counted(known), name, *self._raw[name].columns)
        merge(self.repay_sums, delta("raw_repayments", self._repay_sums), "raw_repayments", "loan_id")
        days = delta("raw_repayments", lambda r: I.value_terms(r, "loan_id", "days_late"))
        merge(self.repay_days, days, "raw_repayments", "loan_id", "value")
        accounts = delta("raw_savings", lambda r: I.counted(self._accounts(r)))
        merge(self.account_rows, accounts, "raw_savings", "account_id", "customer_id")
        txn = delta("raw_transactions", lambda r: I.signed_terms(r, "account_id", {"amount": "amount"}))
        merge(self.txn_sums, txn, "raw_transactions", "account_id")
        side_by_side(steps)

        def newest(rows: BucketTable, now: BucketTable) -> Callable[[], object]:
            mine = only[self._source(rows)]
            return lambda: now.rewrite(mine, number, lambda *_: self._newest(rows, mine))

        kept = ((self.loan_rows, self.loans_now), (self.customer_rows, self.customers_now))
        side_by_side([newest(rows, now) for rows, now in kept if self._source(rows) in raw])

        def touched(*names: str) -> list[int]:
            return sorted({b for name in names for b in only.get(name, [])})

        moved = self._moved_loans(touched("raw_loans"), number)
        owners = touched("raw_savings", "raw_transactions")
        savings = staged.get("raw_savings", I.signed(S.stg_savings(self._raw["raw_savings"])))
        gains = self._customer_gains(moved, savings, self._moved_transactions(owners, number))
        # whole buckets were taken back and added: what did not change adds up to nothing
        gains = gains.filter(reduce(or_, [F.col(c) != 0 for c in gains.columns if c != "customer_id"]))
        flags = I.signed_values(_with_id(moved), "customer_id", "is_default").filter("n_rows <> 0")
        side_by_side(
            [
                lambda: self.customer_sums.add(gains, number, "customer_id"),
                lambda: self.customer_flags.add(flags, number, "customer_id", "value"),
            ]
        )

        loans = touched("raw_loans", "raw_repayments")
        sums = [t.changes(number).select("customer_id") for t in (self.customer_sums, self.customer_flags)]
        people = sorted({*self.customer_sums.touched(union_all(sums)), *touched("raw_customers")})
        side_by_side(
            [
                lambda: self.loan_mart_table.rewrite(loans, number, lambda *_: self._loan_mart_rows(loans)),
                lambda: self.customer_mart_table.rewrite(people, number, lambda *_: self._customer_mart_rows(people)),
            ]
        )

    def _touched(self, raw: dict[str, DataFrame]) -> dict[str, list[int]]:
        """Per changed raw table the buckets of the tables kept of it; the key is the only column looked at."""
        kept = {
            "raw_customers": self.customer_rows, "raw_loans": self.loan_rows, "raw_repayments": self.repay_sums,
            "raw_savings": self.account_rows, "raw_transactions": self.txn_sums,
        }

        def look(name: str) -> tuple[str, list[int]]:
            return name, kept[name].touched(raw[name])

        return dict(side_by_side([lambda name=name: look(name) for name in raw]))

    def _source(self, rows: BucketTable) -> str:
        return "raw_loans" if rows is self.loan_rows else "raw_customers"

    @staticmethod
    def _newest(rows: BucketTable, only: list[int]) -> DataFrame:
        """The newest row that counts of each key in some buckets."""
        return newest_rows(rows.read(only).filter("n_rows > 0").drop("n_rows"), rows.key)

    def _moved_loans(self, only: list[int], number: int) -> DataFrame:
        """The loans of some buckets as they are now and, taken back, as they were."""
        return I.signed(self.loans_now.read(only), self.loans_now.read(only, before=number))

    def _moved_transactions(self, only: list[int], number: int) -> DataFrame:
        """What the accounts of some buckets give their owners now, less what they gave before."""

        def gains(before: int | None) -> DataFrame:
            return self._account_gains(self.account_rows.read(only, before), self.txn_sums.read(only, before))

        was = gains(number)
        back = [(-F.col(c)).alias(c) for c in was.columns if c != "customer_id"]
        return gains(None).unionByName(was.select("customer_id", *back))

    def _loan_mart_rows(self, only: list[int]) -> DataFrame:
        """The mart's rows in some buckets."""
        loans = S.stg_loans(self.loans_now.read(only))
        sums = self.repay_sums.read(only).withColumnRenamed("n_rows", "n_installments")
        worst = I.largest(self.repay_days.read(only), "loan_id", "max_days_late")
        joined = loans.join(sums, "loan_id", "left").join(worst, "loan_id", "left")
        ratio = safe_ratio(I.known_sum("total_paid"), I.known_sum("total_due"))
        joined = joined.withColumn("collection_ratio", ratio)
        like = self._loan_mart_like
        zero = ["n_installments", "total_due", "total_paid", "n_late", "max_days_late"]
        return zero_filled(joined, zero).select([F.col(f.name).cast(f.dataType) for f in like.schema])

    def _customer_mart_rows(self, only: list[int]) -> DataFrame:
        """The mart's rows in some buckets."""
        people = S.stg_customers(I.repeated(self.customer_rows.read(only)))
        sums = self.customer_sums.read(only).drop("n_rows")
        worst = I.largest(self.customer_flags.read(only), "customer_id", "ever_default")
        joined = people.join(sums, "customer_id", "left").join(worst, "customer_id", "left")
        schema = self.customer_mart_table.schema
        facts = [f.name for f in schema if f.name not in _CUSTOMER]
        return zero_filled(joined, facts).select([F.col(f.name).cast(f.dataType) for f in schema])

    # ---- what readers get -------------------------------------------------------

    def loans(self) -> DataFrame:
        """The newest raw row of each loan."""
        return self.loans_now.read()

    def customers(self) -> DataFrame:
        """The newest raw row of each customer."""
        return self.customers_now.read()

    def repeated_loans(self) -> DataFrame:
        """One row: loans that one load brought more than once."""
        in_load = self.loan_rows.read().groupBy("loan_id", "_loaded_at").agg(F.sum("n_rows").alias("n"))
        return in_load.filter("n > 1").agg(F.count_distinct(F.col("loan_id")).alias("n_loans"))

    def loan_mart(self) -> DataFrame:
        return self.loan_mart_table.read()

    def customer_mart(self, as_of=None) -> DataFrame:
        day = F.current_date() if as_of is None else F.lit(as_of).cast("date")
        rows = self.customer_mart_table.read().withColumn("age", years_between(F.col("birth_date"), day))
        return rows.select([F.col(f.name).cast(f.dataType) for f in self._customer_mart_like.schema])


def _with_id(rows: DataFrame) -> DataFrame:
    """Signed loan rows without those that staging drops."""
    return rows.filter(F.col("loan_id").isNotNull())
