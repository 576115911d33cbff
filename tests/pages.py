"""Builders of response pages for the tests: tonnage of an invented harbour.

Cells are ``(quay, cargo, year, text)``.  Pages come with and without the part
that names their table, with lists of one entry as a lone object, and with
further keys.
"""

import json

HARBOUR = "0009100007"
CARGO = {"g0": ("All cargo", None), "g1": ("Grain", "g0"), "g2": ("Timber", "g0")}
QUAYS = {"90100": "North quay", "90200": "South quay"}
YEARS = {"1907000000": "1907", "1908000000": "1908"}


def one_or_many(entries):
    return entries[0] if len(entries) == 1 else entries


def code_lists(cargo=CARGO, quays=QUAYS, years=YEARS, more=None):
    def entry(code, name, parent=None):
        return {"@code": code, "@name": name, "@level": "2" if parent else "1", **({"@parentCode": parent} if parent else {}), **(more or {})}

    lists = [("cat01", "Cargo", [entry(c, n, p) for c, (n, p) in cargo.items()]), ("area", "Quay", [entry(c, n) for c, n in quays.items()]),
             ("time", "Year", [entry(c, n) for c, n in years.items()])]
    return [{"@id": axis, "@name": name, **({"CLASS": one_or_many(entries)} if entries else {})} for axis, name, entries in lists]


def cell(quay="90100", cargo="g1", year="1907000000", text="1", **more):
    return {"@area": quay, "@cat01": cargo, "@time": year, "@unit": "t", "$": text, **{f"@{k}": v for k, v in more.items()}}


def page(cells, *, table=HARBOUR, lang="E", named=True, start=1, total=None, go_on=None, status=0, message="", legend=(("#", "estimate"),), lists=None):
    """One data page as text; ``named=False`` leaves out the request's echo."""
    counters = {"TOTAL_NUMBER": total if total is not None else len(cells), "FROM_NUMBER": start, "TO_NUMBER": start + len(cells) - 1}
    if go_on:
        counters["NEXT_KEY"] = start + len(cells)
    inside = {"RESULT_INF": counters, "CLASS_INF": {"CLASS_OBJ": one_or_many(code_lists() if lists is None else lists)}, "DATA_INF": {}}
    if legend:
        inside["DATA_INF"]["NOTE"] = one_or_many([{"@char": c, "$": t} for c, t in legend])
    if cells:
        inside["DATA_INF"]["VALUE"] = one_or_many(cells)
    root = {"RESULT": {"STATUS": status, "ERROR_MSG": message}}
    if named:
        root["PARAMETER"] = {"STATS_DATA_ID": table, "LANG": lang}
    return json.dumps({"GET_STATS_DATA": root | {"STATISTICAL_DATA": inside}})


def tons(*amounts, **kw):
    return [cell(text=str(a), **kw) for a in amounts]


def describe(table=HARBOUR, lang="E", status=0):
    """A metadata response."""
    return json.dumps({"GET_META_INFO": {"RESULT": {"STATUS": status, "ERROR_MSG": ""}, "PARAMETER": {"STATS_DATA_ID": table, "LANG": lang},
                                         "METADATA_INF": {"TABLE_INF": {"@id": table, "TITLE": {"@no": "7", "$": "Tonnage"}}, "CLASS_INF": {"CLASS_OBJ": code_lists()}}}})


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]
