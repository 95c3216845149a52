"""Stratified hash split and fold assignment."""

from __future__ import annotations

from ..operators.split import assign_split
from ..sources.tables import bookings
from .catalog import register
from .oracle import split_ctes, with_ctes


@register("split_assignment", with_ctes(
    "SELECT booking_id, is_canceled, part, fold FROM tagged",
    *split_ctes("bookings", "is_canceled", "booking_id", 0.3, 5)))
def split_assignment(spark, sf_dir):
    """Test share 0.3 per label, 5 folds over the train rows (md5 hash: portable)."""
    tagged = assign_split(bookings(spark, sf_dir).select("booking_id", "is_canceled"),
                          "is_canceled", 0.3, folds=5, key_cols=["booking_id"],
                          hash_method="md5")
    return tagged.select("booking_id", "is_canceled", "part", "fold")
