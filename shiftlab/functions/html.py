"""Pieces of report documents as string expressions."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

# Colours of the reports.
UP = "e62525aa"
DOWN = "199bd6aa"
BORDER = "border: 2px solid #000066;"


def text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def fill(template: str, **values: Column | str) -> Column:
    """A text with ``{name}`` places, filled from columns."""
    parts: list[Column | str] = []
    for literal, name, _, _ in Formatter().parse(template):
        parts += [literal] if literal else []
        parts += [values[name]] if name else []
    return text(*parts)


def escape(value: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        value = F.replace(value, F.lit(char), F.lit(entity))
    return value


def cell(value: Column) -> Column:
    return text("<td>", value, "</td>")


def signed_cell(shown: Column, value: Column) -> Column:
    """A cell coloured by sign; zero and missing stay plain."""
    style = (
        F.when(value > 0, F.lit(f' style="background-color:#{UP}; {BORDER}"'))
        .when(value < 0, F.lit(f' style="background-color:#{DOWN}; {BORDER}"'))
        .otherwise(F.lit(""))
    )
    return text("<td", style, ">", shown, "</td>")


def row(*cells: Column) -> Column:
    return text("<tr>", *cells, "</tr>")


def table(header: list[str], rows: Column) -> Column:
    head = "".join(f"<th>{name}</th>" for name in header)
    return text(f"<table><tr>{head}</tr>", rows, "</table>")


def joined_rows(order: list[Column], html: Column) -> Column:
    """Aggregate: the row pieces of one document section in the given order; missing ones left out."""
    keyed = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)], html.alias("html"))
    present = F.collect_list(F.when(html.isNotNull(), keyed))
    return F.array_join(F.transform(F.array_sort(present), lambda s: s["html"]), "")
