"""The claim star join as a table that follows its three sides."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.changelog import DELETE, UPSERT
from ..plans.gold import customer_claim_policy
from ..session import hashed_joins
from .follow import pending, rows_replaced, rows_set, stored
from .tables import BUCKETS, FolderTable


class Pairs:
    """Which rows of ``source`` hold which value of ``column``: (column, key), partitioned by the value."""

    def __init__(self, source: FolderTable, column: str, path: str, buckets: int):
        self.source, self.column, self.key = source, column, source.keys[0]
        self.table = FolderTable(source.spark, path, [column, self.key], buckets=buckets, by=[column])

    def follow(self) -> None:
        numbers, whole = pending(self.table, "source", self.source)
        for number in numbers:
            self.table.write(number, lambda before, s=(number, whole): self._change(*s), "source")

    def _change(self, number: int, whole: bool) -> DataFrame:
        pairs = lambda rows, op: rows.where(F.col(self.column).isNotNull()).select(F.lit(op).alias("op"), self.column, self.key)
        if whole:
            return pairs(self.source.read(before=number + 1), UPSERT)
        new, old = rows_set(self.source, number, whole, [self.column]), rows_replaced(self.source, number, whole, [self.column])
        if old is None:
            return pairs(new, UPSERT)
        gone = old.join(new.select(self.column, self.key), [self.column, self.key], "left_anti")
        return pairs(new, UPSERT).union(pairs(gone, DELETE))

    def keys_with(self, values: DataFrame) -> DataFrame:
        """The keys of the rows that hold, or lately held, one of the values (a column of that name)."""
        return self.table.ever(values.select(self.column)).select(self.key).distinct()


class StarJoin:
    """Claims with their policy and customer, kept up by changes on each of the three sides.

    A delivery changes the claims that hold one of its keys: its own claims, those
    of its policies, or those of the policies of its customers, which the pairs
    kept per policy and per customer tell. These claims are joined anew with what
    the sides hold now, once for all deliveries that wait; of the sides, only the
    buckets they lie in are read. A
    claim that has lost its policy or customer, or is gone, leaves the table.
    A policy that holds a third of the claims is one row against many in a join
    whose larger side comes straight from files, so a skewed partition is split.
    """

    def __init__(self, claim: FolderTable, policy: FolderTable, customer: FolderTable, path: str, buckets: int = BUCKETS):
        self.claim, self.policy, self.customer = claim, policy, customer
        self.claims_of = Pairs(claim, "policy_no", f"{path}/claims_of", buckets)
        self.policies_of = Pairs(policy, "cust_id", f"{path}/policies_of", buckets)
        self.table = FolderTable(claim.spark, f"{path}/joined", ["claim_no"], buckets=buckets)

    def follow(self) -> None:
        """Take up all finished deliveries of the three sides, each once."""
        sides = (("claim", self.claim), ("policy", self.policy), ("customer", self.customer))
        if not all(side.exists() for _, side in sides):
            return
        with hashed_joins(self.table.spark):
            self.claims_of.follow()
            self.policies_of.follow()
            waiting: list[tuple[str, int]] = []
            for name, side in sides:
                numbers, whole = pending(self.table, name, side)
                if whole:
                    for number in numbers:
                        self.table.write(number, lambda before, n=name: self._whole(n), name)
                else:
                    waiting += [(name, number) for number in numbers if not self.table.took(name, number)]
            # The first takes up the keys of all, as their claims are joined with what the sides hold now, and the
            # others nothing. A run that breaks off leaves those it has not come to waiting, keys and all.
            for n, (name, number) in enumerate(waiting):
                self.table.write(number, lambda before, n=n: self._change(waiting) if n == 0 else self._set(self.table.read().limit(0)), name)

    def _whole(self, name: str) -> DataFrame:
        """The claims' first delivery makes the whole join; there is nothing left for the others."""
        joined = customer_claim_policy(self.claim.read(), self.policy.read(), self.customer.read())
        return self._set(joined if name == "claim" else joined.limit(0))

    def _changed(self, waiting: list[tuple[str, int]]) -> DataFrame:
        """The claims that hold a key of the deliveries, by the pairs."""
        def keys(name: str, side: FolderTable) -> list[DataFrame]:
            return [side.delivered(number).select(*side.keys) for at, number in waiting if at == name]

        claims, policies, people = keys("claim", self.claim), keys("policy", self.policy), keys("customer", self.customer)
        if people:
            of = reduce(DataFrame.union, people).withColumnRenamed("customer_id", "cust_id")
            policies.append(self.policies_of.keys_with(of))
        if policies:
            claims.append(self.claims_of.keys_with(stored(reduce(DataFrame.union, policies).distinct())))
        return reduce(DataFrame.union, claims).distinct()

    def _change(self, waiting: list[tuple[str, int]]) -> DataFrame:
        # Each step feeds several that follow, so it is written once to the shared folder.
        changed = stored(self._changed(waiting))
        claims = stored(self.claim.read(touching=changed, only=changed))
        of = claims.select("policy_no").distinct()
        policies = stored(self.policy.read(touching=of, only=of))
        people = self.customer.read(touching=policies.select(F.col("cust_id").alias("customer_id")))
        joined = customer_claim_policy(claims, policies, people).withColumn("_there", F.lit(True))
        op = F.when(F.col("_there"), F.lit(UPSERT)).otherwise(F.lit(DELETE))
        rows = changed.join(joined, "claim_no", "left").withColumn("op", op)
        return rows.select("op", *[c for c in joined.columns if c != "_there"])

    def _set(self, joined: DataFrame) -> DataFrame:
        return joined.select(F.lit(UPSERT).alias("op"), "*")
