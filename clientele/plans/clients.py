"""Tables laid out for questions about one client.

Rows are exchanged by ranges of (client, time) and sorted inside the files, so a client's rows are neighbours and a
client with very many rows spreads over files by time. Row groups are small, and each carries the bounds of its client
ids and a Bloom filter on them. A table of the bounds of every file, written beside the rows, tells which files to
open at all: a question about one client reads a few row groups, however large the table is.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.operators.features import ID
from clientele.operators.reports import client
from clientele.operators.serve import profile
from clientele.plans.warehouse import Warehouse
from clientele.sources.storage import store_files

ROW_GROUP_BYTES = 4 << 20

#: Tables kept by client, with the column that orders a client's rows.
BY_CLIENT = {
    "transactions": "txn_datetime", "interactions": "interaction_datetime", "complaints": "opened_date", "cards": "issue_date",
    "accounts": "account_id", "loans": "origination_date", "customers": ID, "customer_360": ID, "nba": ID,
}


@dataclass(frozen=True)
class ClientTable:
    """Rows clustered by client and the id bounds of their files."""

    path: str
    rows: DataFrame
    files: DataFrame

    def of(self, customer_id: str) -> DataFrame:
        """The rows of one client, from the files whose bounds hold the id; the names of those reach the driver."""
        may_hold = self.files.filter((F.col("lowest") <= customer_id) & (F.col("highest") >= customer_id)).select("file").collect()
        if not may_hold:
            return self.rows.limit(0)
        reader = self.rows.sparkSession.read.schema(self.rows.schema)
        return reader.parquet(*[r["file"] for r in may_hold]).filter(F.col(ID) == customer_id)


def clustered(df: DataFrame, name: str, order: str, row_group_bytes: int = ROW_GROUP_BYTES) -> ClientTable:
    """``df`` written by ranges of client; rows without a client belong to nobody's page and stay out."""
    keys = list(dict.fromkeys([ID, order]))
    rows = df.filter(F.col(ID).isNotNull()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    path, written = store_files(rows, f"clients/{name}", {
        "parquet.block.size": str(row_group_bytes), f"parquet.bloom.filter.enabled#{ID}": "true",
    })
    bounds = written.groupBy(F.input_file_name().alias("file")).agg(F.min(ID).alias("lowest"), F.max(ID).alias("highest"))
    _, files = store_files(bounds.coalesce(1), f"clients/{name}_files", {})  # one row a file
    return ClientTable(path, written, files)


class ClientPages:
    """Everything the client page shows of one client, from clustered tables built when first asked for."""

    def __init__(self, w: Warehouse, row_group_bytes: int = ROW_GROUP_BYTES) -> None:
        self._w = w
        self._row_group_bytes = row_group_bytes
        self._tables: dict[str, ClientTable] = {}

    def table(self, name: str) -> ClientTable:
        if name not in self._tables:
            gold = {"customer_360": lambda: self._w.customer_360, "nba": lambda: self._w.nba}
            rows = gold[name]() if name in gold else self._w.table(name)
            self._tables[name] = clustered(rows, name, BY_CLIENT[name], self._row_group_bytes)
        return self._tables[name]

    def of(self, name: str, customer_id: str) -> DataFrame:
        return self.table(name).of(customer_id)

    @cached_property
    def _channels(self) -> DataFrame:
        return self._w.table("channels")

    def monthly_activity(self, customer_id: str) -> DataFrame:
        return client.monthly_activity(self.of("transactions", customer_id))

    def recent_txns(self, customer_id: str) -> DataFrame:
        return client.recent_txns(self.of("transactions", customer_id), self._channels)

    def recent_interactions(self, customer_id: str) -> DataFrame:
        return client.recent_interactions(self.of("interactions", customer_id))

    def open_complaints(self, customer_id: str) -> DataFrame:
        return client.open_complaints(self.of("complaints", customer_id))

    def product_snapshot(self, customer_id: str) -> DataFrame:
        return client.product_snapshot(*[self.of(t, customer_id) for t in ("customers", "cards", "accounts", "loans")])

    def detail(self, customer_id: str) -> DataFrame:
        return client.client_detail(*[self.of(t, customer_id) for t in ("customer_360", "nba", "customers")])

    def advisor_action(self, customer_id: str) -> DataFrame:
        return client.advisor_action(self.of("customer_360", customer_id))

    def profile(self, customer_id: str) -> DataFrame:
        return profile(self.of("customer_360", customer_id), self.of("nba", customer_id), customer_id)
