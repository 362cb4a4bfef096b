"""Declared schemas of the changelog and the wide table."""

import re

from pyspark.sql import types as T


def columns(listed: str) -> T.StructType:
    """A schema from "name type, ..."; types by their JSON names."""
    out = T.StructType()
    for name, kind in re.findall(r"(\w+) (\w+(?:\([\d,]+\))?)", listed):
        out = out.add(name, kind)
    return out


REPORT = columns(
    "db_name string, tbl_name string, op_ts string, record_id string, productionorderid long, workcenterid long, createdbyid long, lotno string, lpnbarcode string, "
    "modelencode string, model string, users string, finishedquantity decimal(38,4), quantity integer, createddate timestamp_ntz, scantime timestamp_ntz"
)
ORDER = columns(
    "db_name string, op_ts string, productionorderid long, productionorderno string, orderquantity long, worksiteid long, partid long, createddate timestamp_ntz, duedate timestamp_ntz"
)
WIDE = columns(
    "record_id string, version long, company string, datasource string, outputtype string, productionorder string, productionorderid long, lpnbarcode string, username string, partcode string, "
    "partname string, linecode string, linename string, workcentertype string, workshop string, orderquantity long, ordercreateddate timestamp_ntz, orderduedate timestamp_ntz, "
    "lotquantity decimal(38,4), outputdatetime timestamp_ntz, shift_date date, is_deleted boolean"
)
RECORD_KEY = ["company", "datasource", "outputtype", "record_id"]
MINUTE_KEY = ["ts_minute", "company", "workshop", "linecode", "partcode"]


def envelope(row: T.StructType) -> T.StructType:
    return T.StructType().add("op", "string").add("before", row).add("after", row)
