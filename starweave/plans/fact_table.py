"""The fact table, kept equal to a rebuild as dimension members arrive late or change.

A line whose customer, product or day is not known yet is loaded with a NULL key, and
(role, business key, ``order_date``) goes into a small index beside the fact. A later
``repair`` meets the index with the dimensions of that time: entries whose member has
come by then name the partitions to mend, and no others are listed, read or written.
Members that were known but changed what the fact copies from them (a customer's
place, a product's cost) are found by a scan of one key column and the partition column.

The rows carry their business keys beside the fact's columns (``read`` leaves them out). So a
repair meets the rows of these partitions with the members that came or changed, few against
the dimensions, and writes the partitions that changed where they are: the other members,
the order lines and the lines' measures are neither read from Silver nor shuffled. Tables
without these columns, and partitions that a died job has lost, are mended from Silver.

The index holds one row for each unknown (key, day), so it grows with what is missing
and not with the fact. It is a superset at any time: a load commits its entries before
its rows, a repair drops entries after its rows, and a partition that is mended twice
stays as it is. Only the first load reads its entries from the rows that it wrote; while
there is no index yet, the rows stand for it. A job that died is repeated as a whole. One
writer at a time.

Lines without a business key never resolve and are not in the index. Members are never
deleted (Type 1), so a key that was resolved stays so.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.lookup import lookup
from ..sources import tables
from ..sources.ingest import _ts
from . import fact

PARTITION = "order_date"
INDEX = "unresolved"
_KEYS = ["role", "business_key"]
# role → (business key of the order line, key of the fact); order and ship dates share the calendar.
ROLES = (("customer", "customer_id", "customer_sk"), ("product", "product_id", "product_sk"),
         ("date", "order_date", "order_date_sk"), ("date", "ship_date", "ship_date_sk"))


# Order columns that the rows carry for repairs.
CARRIED = [bk for _, bk, _ in ROLES if bk not in fact.FACT_COLUMNS]
#: Members of one role that are sent to every task of a repair; for more, rows and members are shuffled.
FEW_MEMBERS = 500_000


@dataclass(frozen=True)
class Dimensions:
    customer: DataFrame
    product: DataFrame
    date: DataFrame
    geography: DataFrame

    def fact(self, orders: DataFrame, now=None, keep=(), lay_by=()) -> DataFrame:
        return fact.fact_sales(orders, self.customer, self.product, self.date, self.geography, now, keep, lay_by)

    def members(self) -> DataFrame:
        """role, business_key, sk, copied: every member, and what the fact copies from it besides its key."""
        c = fact.customer_keys(self.customer, self.geography).select(
            F.lit("customer"), F.col("customer_bk").cast("string"), F.col("customer_sk"), F.col("geography_sk").cast("string"))
        p = self.product.select(F.lit("product"), F.col("product_bk").cast("string"), F.col("product_sk"), F.col("unit_cost").cast("string"))
        d = self.date.select(F.lit("date"), F.col("full_date").cast("string"), F.col("date_key").cast("long"), F.lit(None).cast("string"))
        return c.union(p).union(d).toDF("role", "business_key", "sk", "copied")


def changed_members(before: Dimensions, after: Dimensions) -> DataFrame:
    """role, business_key, sk (the old one): members of both whose key or copied values differ."""
    old = before.members().withColumnsRenamed({"sk": "__sk", "copied": "__copied"})
    both = after.members().join(old, _KEYS)
    same = F.col("sk").eqNullSafe(F.col("__sk")) & F.col("copied").eqNullSafe(F.col("__copied"))
    return both.filter(~same).select(*_KEYS, F.col("__sk").alias("sk"))


def unresolved(rows: DataFrame) -> DataFrame:
    """Index entries of fact rows that carry their business keys: only rows with a NULL key are unpivoted."""
    missing = [F.when(F.col(sk).isNull() & F.col(bk).isNotNull(),
                      F.struct(F.lit(role).alias("role"), F.col(bk).cast("string").alias("business_key")))
               for role, bk, sk in ROLES]
    lacking = rows.withColumn("__m", F.array_compact(F.array(*missing))).filter(F.size("__m") > 0)
    return lacking.select(PARTITION, F.explode("__m").alias("m")).select("m.role", "m.business_key", PARTITION).distinct()


def mended(rows: DataFrame, customer: DataFrame, product: DataFrame, date: DataFrame, now=None) -> DataFrame:
    """``rows`` (with their business keys) after the given members came or changed; ``__changed`` marks those that did.

    ``customer(customer_bk, customer_sk, geography_sk)``, ``product(product_bk, product_sk, unit_cost)`` and
    ``date(full_date, date_key)`` hold these members only.
    """
    new = rows
    copies = []
    for dim, bk, key, columns in ((customer, "customer_id", "customer_bk", {"customer_sk": "customer_sk", "geography_sk": "geography_sk"}),
                                  (product, "product_id", "product_bk", {"product_sk": "product_sk", "unit_cost": "unit_cost"}),
                                  (date, "order_date", "full_date", {"order_date_sk": "date_key"}),
                                  (date, "ship_date", "full_date", {"ship_date_sk": "date_key"})):
        hit = f"__hit_{bk}"
        new = lookup(new, dim.withColumn("__hit", F.lit(True)), bk, key, {hit: "__hit", **{f"__new_{c}": src for c, src in columns.items()}})
        copies += [(c, F.when(F.col(hit), F.col(f"__new_{c}")).otherwise(F.col(c))) for c in columns]
    changed = F.lit(False)
    for c, value in copies:
        changed = changed | ~value.eqNullSafe(F.col(c))
    new = new.withColumn("__changed", changed)
    new = new.withColumns({c: value for c, value in copies} | {
        "updated_at": F.when(F.col("__changed"), _ts(now)).otherwise(F.col("updated_at"))})
    return fact.with_measures(new).select(*rows.columns, "__changed")


class FactTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.rows_path = f"{self.path}/rows"
        self.store = tables.TableStore(spark, f"{self.path}/index")

    def rows(self) -> DataFrame:
        """The fact's rows with the business keys that they carry."""
        return tables.read(self.spark, self.rows_path)

    def read(self) -> DataFrame:
        return self.rows().select(*fact.FACT_COLUMNS)

    def _carries(self) -> bool:
        """Whether the rows carry their business keys (a table of an earlier version does not)."""
        logged = tables.logged_schema(self.spark, self.rows_path)
        return logged is None or set(CARRIED) <= set(logged.names)

    def index(self) -> DataFrame:
        """role, business_key, order_date of the lines that wait for a member."""
        if self.store.exists(INDEX):
            return self.store.read(INDEX)
        if tables.committed(self.spark, self.rows_path) and self._carries():  # a first load that died before its index
            return unresolved(self.rows())
        return self.spark.createDataFrame([], "role string, business_key string, order_date date")

    def _keep_index(self, entries: DataFrame) -> None:
        self.store.commit(INDEX, entries.sort(*_KEYS))
        self.store.vacuum(INDEX)

    def _publish(self, orders: DataFrame, dims: Dimensions, now, staged: list) -> dict:
        """Index entries, then rows, of some orders."""
        rows = tables.stage(dims.fact(orders, now, CARRIED), "fact_rows", track=staged)
        self._keep_index(self.index().unionByName(unresolved(rows)).distinct())
        carried = CARRIED if self._carries() else []
        return tables.publish_partitions(rows.select(*fact.FACT_COLUMNS, *carried), self.rows_path, ["order_line_id"],
                                         [*fact.FACT_UPDATE_COLUMNS, *carried, "updated_at"], PARTITION, now, source_is_staged=True)

    def load(self, orders: DataFrame, dims: Dimensions, now=None) -> dict:
        """Upsert the lines of ``orders`` (a batch of Silver, one row a line)."""
        staged: list = []
        try:
            if tables.committed(self.spark, self.rows_path):
                return self._publish(orders, dims, now, staged)
            # Nothing to merge with: the rows are written once, and the index is read from them.
            rows = dims.fact(orders, now, CARRIED, lay_by=[PARTITION, "order_line_id"])
            info = tables.publish_partitions(rows, self.rows_path, ["order_line_id"], [], PARTITION, now, laid=True)
            self._keep_index(unresolved(self.rows()))
            return info
        finally:
            tables.drop_paths(self.spark, staged)

    def due(self, after: Dimensions) -> DataFrame:
        """Index entries whose member is there now, whatever load brought it."""
        return self.index().join(after.members().select(*_KEYS), _KEYS, "left_semi")

    def repair(self, orders: DataFrame, after: Dimensions, before: Dimensions | None = None, now=None) -> dict:
        """Mend the partitions of late members, and of members changed since ``before``.

        ``orders`` is all of Silver; only rows of partitions that the table cannot mend by
        itself are read from it (by literal values). Returns the partitions looked at and rewritten.
        """
        staged: list = []
        try:
            due = tables.stage(self.due(after), "due", track=staged)
            days, came = due.select(PARTITION), due.select(*_KEYS).distinct()
            members = came
            if before is not None:
                moved = tables.stage(changed_members(before, after), "moved", track=staged)
                members = members.union(moved.select(*_KEYS)).distinct()
                slim = self.read()
                for role, column in (("customer", "customer_sk"), ("product", "product_sk")):
                    sks, _ = _sent(moved.filter(F.col("role") == role).select(F.col("sk").alias(column)))
                    days = days.union(slim.select(column, PARTITION).join(sks, column, "left_semi").select(PARTITION))
            near = {r[0] for r in days.distinct().collect()}  # partition values
            if not near:
                return {"partitions": 0, "touched": 0}
            fs, p = tables._fs(self.spark, self.rows_path)
            there = {s.getPath().getName() for s in fs.listStatus(p)}
            own = {v for v in near if self._carries() and tables.partition_folder(self.spark, PARTITION, v) in there}
            touched = self._mend(own, after, members, now, staged) if own else 0
            if near - own:
                touched += self._publish(orders.filter(tables._any_of(PARTITION, near - own)), after, now, staged)["touched"]
            self._keep_index(self.index().join(came, _KEYS, "left_anti"))
            return {"partitions": len(near), "touched": touched}
        finally:
            tables.drop_paths(self.spark, staged)

    def _mend(self, days: set, after: Dimensions, members: DataFrame, now, staged: list) -> int:
        """Rewrite those of the partitions ``days`` whose rows change by these ``members``; returns their number."""
        sides, few = [], True
        for role, dim, key in (("customer", fact.customer_keys(after.customer, after.geography), "customer_bk"),
                               ("product", after.product.select("product_bk", "product_sk", "unit_cost"), "product_bk"),
                               ("date", after.date.select("full_date", "date_key"), "full_date")):
            wanted = members.filter(F.col("role") == role).select(F.col("business_key").cast(dim.schema[key].dataType).alias(key))
            side, small = _sent(tables.stage(dim.join(wanted, key, "left_semi"), f"late_{role}", track=staged))
            sides.append(side)
            few = few and small
        known = tables.logged_schema(self.spark, self.rows_path)
        part = lambda values: mended(tables._partitions(self.spark, self.rows_path, PARTITION, values, known), *sides, now)
        touched = {r[0] for r in part(days).filter("__changed").select(PARTITION).distinct().collect()}
        if touched:
            # The new files replace the old ones when the job commits, after all were read. Rows that met few
            # members are still where their partitions were read, so they are not shuffled to be written.
            tables.write(part(touched).drop("__changed"), self.rows_path, "overwrite", [PARTITION], cluster_by=["order_line_id"],
                         dynamic=True, spread=not few)
        return len(touched)


def _sent(staged: DataFrame) -> tuple[DataFrame, bool]:
    """A staged side of a join, sent to every task where its counted rows are few; whether they are."""
    few = staged.count() <= FEW_MEMBERS
    return (F.broadcast(staged) if few else staged), few
