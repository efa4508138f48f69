"""Builders for small export folders."""

from xml.sax.saxutils import escape


def column(name, kind="AlphaNumeric", accuracy=None, length=None, description=None, key=False):
    parts = [f"<Name>{escape(name)}</Name>"]
    if description is not None:
        parts.append(f"<Description>{escape(description)}</Description>")
    inner = "" if accuracy is None else f"<Accuracy>{accuracy}</Accuracy>"
    if kind:
        parts.append(f"<{kind}>{inner}</{kind}>")
    if length is not None:
        parts.append(f"<MaxLength>{length}</MaxLength>")
    tag = "VariablePrimaryKey" if key else "VariableColumn"
    return f"<{tag}>{''.join(parts)}</{tag}>"


def table(name, columns, url=None, extra="", first=None):
    span = "" if first is None else f"<Range><From>{first}</From></Range>"
    url = f"{name}.txt" if url is None else url
    return (
        f"<Table><URL>{escape(url)}</URL><Name>{escape(name)}</Name>{extra}{span}"
        f"<VariableLength>{''.join(columns)}</VariableLength></Table>"
    )


def index(*tables):
    return (
        '<?xml version="1.0" encoding="UTF-8"?><!DOCTYPE DataSet SYSTEM "audit.dtd">\n'
        f"<DataSet><Media><Name>Test</Name>{''.join(tables)}</Media></DataSet>"
    )


def write_export(folder, tables, files):
    """An export folder; file contents are text (UTF-8) or bytes."""
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "index.xml").write_text(index(*tables), encoding="utf-8")
    for name, content in files.items():
        data = content.encode() if isinstance(content, str) else content
        (folder / name).write_bytes(data)
    return str(folder)


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def status(result, name):
    """(row count, status) of a table in a report."""
    found = [r for r in result.report.collect() if r["table_name"] == name]
    assert len(found) == 1, f"{name}: {found}"
    return found[0]["row_count"], found[0]["status"]


# Customers and bookings of a small export.
KUNDEN = [
    column("Nr", length=20, description="Kundennummer", key=True),
    column("Name", length=100, description="Kundenname"),
    column("Saldo", "Numeric", 2, 20, "Kontosaldo"),
    column("ErstellDatum", "Date", description="Erstellungsdatum"),
    column("Anzahl", "Numeric", description="Anzahl Bestellungen"),
]
KUNDEN_TEXT = (
    "D17;Nördlich Werft AG;9.871,03;07.11.2021;8\n"
    "D18;Ohm & Söhne OHG;-44,12;30.04.2022;31\n"
    "D19;Straßenbau Jäger;0,00;29.02.2020;0\n"
)
BUCHUNGEN = [
    column("LfdNr", "Numeric", key=True),
    column("KontoNr"),
    column("Betrag", "Numeric", 2),
    column("BuchungsDatum", "Date"),
]
BUCHUNGEN_TEXT = (
    "1;4000;12.040,90;01.06.2024\n2;8000;-7,05;15.06.2024\n3;4000;618,00;30.06.2024\n"
)
