"""Traffic-light colours of the report tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sellerlens.functions.columns import _col
from sellerlens.policy import HIGH, LOW, MEDIUM

# The dashboard's palette.
RED, AMBER, GREEN, GREY = "#ef4444", "#f59e0b", "#22c55e", "#64748b"
LABEL = {HIGH: RED, MEDIUM: AMBER, LOW: GREEN}
LABEL_OTHER = "#94a3b8"
BACKGROUND = {HIGH: "#fee2e2", MEDIUM: "#fef3c7", LOW: "#dcfce7"}
BACKGROUND_OTHER = "#f1f5f9"
TEXT = {HIGH: "#b91c1c", MEDIUM: "#92400e", LOW: "#15803d"}
TEXT_OTHER = "#475569"
PLOT = {HIGH: "red", MEDIUM: "orange", LOW: "green"}


def _lookup(label: Column | str, colours: dict[str, str], other: str | None) -> Column:
    found = F.lit(other)
    for name, colour in colours.items():
        found = F.when(_col(label) == name, F.lit(colour)).otherwise(found)
    return found


def label_colour(label: Column | str) -> Column:
    return _lookup(label, LABEL, LABEL_OTHER)


def label_background(label: Column | str) -> Column:
    return _lookup(label, BACKGROUND, BACKGROUND_OTHER)


def label_text_colour(label: Column | str) -> Column:
    return _lookup(label, TEXT, TEXT_OTHER)


def plot_colour(label: Column | str) -> Column:
    """Named plot colours; an unknown label has none."""
    return _lookup(label, PLOT, None)


def return_rate_colour(percent: Column | str) -> Column:
    return F.when(_col(percent) > 40, RED).when(_col(percent) > 20, AMBER).otherwise(GREEN)


def complaint_colour(high_complaints: Column | str) -> Column:
    return F.when(_col(high_complaints) >= 5, RED).otherwise(GREY)


def verification_colour(status: Column | str) -> Column:
    return F.when(_col(status) == "verified", GREEN).otherwise(RED)
