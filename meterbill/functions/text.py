"""String building with the two NULL dialects of the source databases.

* Oracle treats NULL as the empty string inside ``||`` and the empty string as
  NULL: ``concat_null_as_empty``.
* Firebird propagates NULL through ``||``: ``concat_null_propagating``.

The address renderers are built on one or the other, never mixed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _text(c: str | Column) -> Column:
    return _col(c).cast("string")


def concat_null_as_empty(*cols: str | Column) -> Column:
    """Oracle ``a || b``: NULL parts vanish; an all-empty result is NULL."""
    joined = F.concat_ws("", *[_text(c) for c in cols])
    return F.when(joined != F.lit(""), joined)


def concat_null_propagating(*cols: str | Column) -> Column:
    """Firebird/ANSI ``a || b``: any NULL part makes the whole NULL."""
    return F.concat(*[_text(c) for c in cols])


def iif(cond: Column, then: Column | str, otherwise: Column | str) -> Column:
    """Firebird ``IIF``: a NULL condition takes the else branch."""
    t = then if isinstance(then, Column) else F.lit(then)
    o = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    return F.when(cond, t).otherwise(o)


@dataclass(frozen=True)
class OracleAddressLabels:
    default_city: str
    house: str
    corpus: str
    building: str
    flat: str


@dataclass(frozen=True)
class FirebirdAddressLabels:
    city_raw: str
    city_final: str
    street: str
    house: str
    corpus: str
    flat: str


# ---------------------------------------------------------------------------
# Address wording of the original jobs.
# ---------------------------------------------------------------------------
ORACLE_LABELS = OracleAddressLabels(
    default_city="г. Киров", house=", д. ", corpus=", корп. ", building=", стр. ", flat=", кв. ")
FIREBIRD_LABELS = FirebirdAddressLabels(
    city_raw="Киров г", city_final="г. Киров", street=", ул. ", house=", д. ",
    corpus=" корп. ", flat=", кв. ")
# ---------------------------------------------------------------------------

# The same wording in the stand-in fixtures (FIXTURES.md sample addresses).
FIXTURE_ORACLE_LABELS = OracleAddressLabels(
    default_city="City", house=", d. ", corpus=", k. ", building=", b. ", flat=", f. ")
FIXTURE_FIREBIRD_LABELS = FirebirdAddressLabels(
    city_raw="Town c", city_final="c. Town", street=", st. ", house=", h. ",
    corpus=" k. ", flat=", f. ")


def address_null_as_empty(town_name: Column, town_type: Column, street_name: Column,
                          street_type: Column, house: Column, corpus: Column,
                          building: Column, flat: Column,
                          labels: OracleAddressLabels = ORACLE_LABELS) -> Column:
    """Full address with Oracle NULL rules.

    ``town_name``/``town_type`` are the already coalesced role-playing towns.
    The blank between street type and street name is unconditional, so a
    missing street renders as ``"<town> , d. 5"``.
    """
    town = F.when(town_name.isNull(), F.lit(labels.default_city)).otherwise(
        concat_null_as_empty(town_type, F.lit(" "), town_name))
    street_sep = F.when(street_name.isNull(), F.lit("")).otherwise(F.lit(", "))
    return concat_null_as_empty(
        town, street_sep, street_type, F.lit(" "), street_name, F.lit(labels.house), house,
        F.when(corpus.isNotNull(), concat_null_as_empty(F.lit(labels.corpus), corpus)),
        F.when(building.isNotNull(), concat_null_as_empty(F.lit(labels.building), building)),
        F.when(flat.isNotNull(), concat_null_as_empty(F.lit(labels.flat), flat)),
    )


def address_null_propagating(city_name: Column, street_name: Column, dom: Column, dom2: Column,
                             korp: Column, kv: Column, kv2: Column,
                             labels: FirebirdAddressLabels = FIREBIRD_LABELS) -> Column:
    """Full address with Firebird NULL rules.

    An unmatched city, street, house number or a NULL flat number make the
    whole address NULL; ``dom2``, ``korp`` and ``kv2`` are guarded and never
    do.  An empty city name renders the bare default city.  Finally every
    occurrence of the raw city text is replaced by its display form.
    """
    city = iif(city_name == F.lit(""), F.lit(labels.city_raw),
               concat_null_propagating(F.lit(labels.city_raw + " ("), city_name, F.lit(")")))
    raw = concat_null_propagating(
        city, F.lit(labels.street), street_name, F.lit(labels.house), dom,
        iif(F.char_length(dom2) > 0, _text(dom2), F.lit("")),
        iif(F.char_length(korp) > 0, concat_null_propagating(F.lit(labels.corpus), korp), F.lit("")),
        iif(kv == 0, F.lit(""), concat_null_propagating(F.lit(labels.flat), kv)),
        iif(kv2.isNull(), F.lit(""), _text(kv2)),
    )
    return F.replace(raw, F.lit(labels.city_raw), F.lit(labels.city_final))
