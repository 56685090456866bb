"""Queries of the stage mappings: each is a list of (target, Spark SQL expression)."""

from __future__ import annotations

from millrace.operators.cleaning import apply_mapping
from millrace.plans.registry import query
from millrace.sources.adapters import view

_KEY = "CASE WHEN btrim({0}) RLIKE '^[0-9]+$' THEN try_cast(btrim({0}) AS bigint) END"
_TEXT = "nullif(btrim({0}), '')"
_TIME = "CASE WHEN btrim({0}) NOT IN ('', '1900-01-01') THEN try_cast(btrim({0}) AS timestamp_ntz) END"
_NUM = "CAST(try_cast(btrim({0}) AS decimal(38,10)) AS double)"
# The same four in the oracle's SQL.
_SQL = {"k": "CASE WHEN regexp_matches(trim({0}), '^[0-9]+$') THEN TRY_CAST(trim({0}) AS BIGINT) END", "t": "nullif(trim({0}), '')", "d": "CASE WHEN trim({0}) NOT IN ('', '1900-01-01') THEN TRY_CAST(trim({0}) AS TIMESTAMP) END", "n": "CAST(TRY_CAST(trim({0}) AS DECIMAL(38,10)) AS DOUBLE)"}
_SPARK = {"k": _KEY, "t": _TEXT, "d": _TIME, "n": _NUM}

# stage: source view, (target, kind, source column)
STAGES = {
    "n25a_serial_mark_normalization": ("raw_line", [("recid_text", "t", "recid"), ("recid_bigint", "k", "recid"), ("item_id", "t", "itemid"), ("mark_code", "t", "markcode"), ("created_datetime", "d", "created")]),
    "n25b_serial_mark": ("raw_line", [("source_recid", "k", "recid"), ("item_id", "t", "itemid"), ("mark_code", "t", "markcode"), ("created_datetime", "d", "created"), ("data_area_id", "t", "dataareaid")]),
    "n25c_picking_route": ("raw_sales", [("source_recid", "k", "recid"), ("picking_route_id", "t", "salesid"), ("employee_id", "t", "custaccount"), ("status", "t", "salesstatus"), ("start_date", "d", "deliverydate"), ("modified_datetime", "d", "modifieddatetime"), ("data_area_id", "t", "dataareaid")]),
    "n25d_pack_task": ("raw_line", [("source_recid", "k", "recid"), ("task_id", "t", "orderid"), ("created_datetime", "d", "created"), ("data_area_id", "t", "dataareaid")]),
    "n25e_order_trans": ("raw_line", [("source_recid", "k", "recid"), ("order_id", "t", "orderid"), ("item_id", "t", "itemid"), ("qty", "n", "qty"), ("created_datetime", "d", "created"), ("data_area_id", "t", "dataareaid")]),
    "n25g_purchase_order": ("raw_line", [("purchase_id", "t", "orderid"), ("vendor_account", "t", "vendor"), ("order_date", "d", "created"), ("data_area_id", "t", "dataareaid")]),
    "n25m_order_trans_staging": ("raw_line", [("recid_text", "t", "recid"), ("recid", "k", "recid"), ("qty", "n", "qty"), ("created_datetime", "d", "created")]),
    "n25h_product": ("raw_line", [("item_id", "t", "itemid"), ("item_name", "t", "markcode"), ("data_area_id", "t", "dataareaid")]),
    "n25l_warehouse_operation": ("raw_sales", [("employee_id", "t", "custaccount"), ("operation_type", "t", "salesstatus"), ("start_time", "d", "deliverydate"), ("duration", "n", "amount")]),
}


def _stage(name: str, source: str, fields: list[tuple[str, str, str]]) -> None:
    sql = "SELECT " + ", ".join(f"{_SQL[k].format(c)} AS {t}" for t, k, c in fields) + f" FROM {{{source}}}"
    mapping = [(t, _SPARK[k].format(c)) for t, k, c in fields]

    @query(name, sql)
    def run(spark, d):
        return apply_mapping(view(spark, d, source), mapping)


for _name, (_source, _fields) in STAGES.items():
    _stage(_name, _source, _fields)
