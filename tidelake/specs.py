"""Catalogue of the four sales tables and the four KPI tables."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

LOAD_DATE = "date"


@dataclass(frozen=True)
class TableSpec:
    """One table: source columns and types, key, and how it is loaded.

    A table with ``day_column`` is incremental: a run loads the rows whose text
    ``day_column`` equals the run date.  Otherwise every run loads the whole
    table as a snapshot, and silver keeps the latest snapshot row per ``key``.
    """

    name: str
    schema: T.StructType
    key: tuple[str, ...] = ()
    day_column: str | None = None

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def incremental(self) -> bool:
        return self.day_column is not None

    @property
    def split_column(self) -> str:
        """A numeric column with many values, to split a relational scan on."""
        return self.key[0] if self.key else self.columns[0]

    @property
    def query(self) -> str:
        """The column-list query sent to a relational source."""
        return f"SELECT {', '.join(self.columns)} FROM {self.name}"

    @property
    def lake_schema(self) -> T.StructType:
        """Source columns plus the load date, as stored in bronze and silver."""
        return T.StructType([*self.schema.fields, T.StructField(LOAD_DATE, T.DateType())])

    def wide(self) -> TableSpec:
        """The same table with BIGINT in place of INT.

        INT ids overflow past 2.1 billion rows, which large lakes reach.
        """
        fields = [
            T.StructField(f.name, T.LongType() if f.dataType == T.IntegerType() else f.dataType)
            for f in self.schema.fields
        ]
        return replace(self, schema=T.StructType(fields))


@dataclass(frozen=True)
class KpiSpec:
    """One KPI table; ``default_rows`` stand in when it was never written."""

    name: str
    schema: T.StructType
    default_rows: tuple[tuple, ...] = ()


INT, BIGINT, DOUBLE = T.IntegerType(), T.LongType(), T.DoubleType()
STRING, DATE = T.StringType(), T.DateType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Table names, column names, keys and KPI folder names.
SALES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        TableSpec(
            "customers",
            _schema(customerid=INT, firstname=STRING, lastname=STRING, email=STRING, phone=STRING),
            key=("customerid",),
        ),
        TableSpec(
            "products",
            _schema(productid=INT, productname=STRING, price=DOUBLE, stockquantity=INT),
            key=("productid",),
        ),
        TableSpec(
            "orderitems",
            _schema(orderitemid=INT, orderid=INT, productid=INT, quantity=INT, itemprice=DOUBLE),
            key=("orderitemid",),
        ),
        TableSpec(
            "orders",
            _schema(orderid=INT, customerid=INT, orderdate=STRING, totalamount=DOUBLE),
            day_column="orderdate",
        ),
    )
}

KPIS: dict[str, KpiSpec] = {
    spec.name: spec
    for spec in (
        KpiSpec(
            "total_orders",
            _schema(total_orders=BIGINT, ref_date=DATE),
            default_rows=((0, None),),
        ),
        KpiSpec(
            "top_5_orders_value",
            _schema(orderid=BIGINT, firstname=STRING, lastname=STRING, totalamount=DOUBLE, orderdate=STRING),
        ),
        KpiSpec("top_5_products_sold", _schema(productname=STRING, total_sold=BIGINT)),
        KpiSpec("low_stock_products", _schema(productname=STRING, stockquantity=BIGINT)),
    )
}


def wide_sales() -> dict[str, TableSpec]:
    return {name: spec.wide() for name, spec in SALES.items()}
