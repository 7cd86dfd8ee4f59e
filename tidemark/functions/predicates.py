"""Row predicates with explicit three-valued logic."""
from __future__ import annotations

from pyspark.sql import Column, functions as F


def non_blank(c) -> Column:
    """Not NULL and not the empty string."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNotNull() & (c != F.lit(""))


def drop_unshipped_international(po_type="PO_TYPE", ct_shipment="SC_CT_SHIPMENT_ID") -> Column:
    """``NOT (type = 'INTERNATIONAL' AND shipment IS NULL)`` as a WHERE.

    Three-valued: a NULL type with no shipment evaluates to NULL and is
    dropped; a NULL type with a shipment is kept.
    """
    t = F.col(po_type) if isinstance(po_type, str) else po_type
    s = F.col(ct_shipment) if isinstance(ct_shipment, str) else ct_shipment
    return ~((t == F.lit("INTERNATIONAL")) & s.isNull())
