"""Tables, headings, links and season evidence of HTML pages, by the standard parser in Arrow batches."""

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.core import fee, href_id, internal_promotion

CELL = "struct<text string, hrefs array<string>, link_texts array<string>>"
TABLES = f"array<struct<pos int, id string, heading string, hidden boolean, rows array<array<{CELL}>>>>"

#: Unicode's space separators.
_SPACES = " \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"


class _Reader(HTMLParser):
    """Tables in page order, each with the last heading above it; comments are parsed too if asked."""

    def __init__(self, comments: bool):
        super().__init__(convert_charrefs=True)
        self.comments, self.hidden = comments, False
        self.tables: list[dict] = []
        self.open: list[dict] = []
        self.heading, self.in_heading, self.title, self.in_title, self.titles = "", False, "", False, 0
        self.h1: list[str] = []
        self.options: list[str] = []
        self.option: str | None = None
        self.link: list | None = None

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if re.fullmatch(r"h[1-6]", tag):
            self.heading, self.in_heading = "", True
            if tag == "h1":
                self.h1.append("")
        elif tag == "title":
            self.in_title, self.titles = self.titles == 0, self.titles + 1
        elif tag == "table":
            t = {"pos": len(self.tables), "id": a.get("id"), "heading": " ".join(self.heading.split()), "hidden": self.hidden, "rows": []}
            self.tables.append(t)
            self.open.append(t)
        elif tag == "tr" and self.open:
            self.open[-1]["rows"].append([])
        elif tag in ("td", "th") and self.open:
            if not self.open[-1]["rows"]:
                self.open[-1]["rows"].append([])
            self.open[-1]["rows"][-1].append({"text": "", "hrefs": [], "link_texts": []})
        elif tag == "a" and (cell := self._cell()) is not None and a.get("href"):
            cell["hrefs"].append(a["href"])
            cell["link_texts"].append("")
            self.link = cell["link_texts"]
        elif tag == "option" and "selected" in a:
            self.option = ""

    def _cell(self):
        return self.open[-1]["rows"][-1][-1] if self.open and self.open[-1]["rows"] and self.open[-1]["rows"][-1] else None

    def handle_endtag(self, tag):
        if re.fullmatch(r"h[1-6]", tag):
            self.in_heading = False
        elif tag == "title":
            self.in_title = False
        elif tag == "table" and self.open:
            self.open.pop()
        elif tag == "a":
            self.link = None
        elif tag in ("option", "select") and self.option is not None:
            self.options.append(" ".join(self.option.split()))
            self.option = None

    def handle_data(self, data):
        if self.in_title:
            self.title += data
        if self.in_heading:
            self.heading += data
            if self.h1:
                self.h1[-1] += data
        if self.option is not None:
            self.option += data
        if (cell := self._cell()) is not None:
            cell["text"] += data
            if self.link is not None and self.link:
                self.link[-1] += data

    def handle_comment(self, data):
        if self.comments and "<table" in data:
            inner = _Reader(False)
            inner.hidden, inner.heading = True, self.heading
            inner.feed(data)
            for t in inner.tables:
                t["pos"] = len(self.tables)
                self.tables.append(t)


def _read(source: str | None, comments: bool = True) -> _Reader:
    r = _Reader(comments)
    r.feed(source or "")
    r.close()
    for t in r.tables:
        for row in t["rows"]:
            for cell in row:
                cell["text"] = " ".join(cell["text"].split())
                cell["link_texts"] = [" ".join(x.split()) for x in cell["link_texts"]]
    return r


def tables_of(source: str) -> Column:
    def run(pages: pd.Series) -> pd.Series:
        return pd.Series([_read(s).tables for s in pages])

    return F.pandas_udf(run, TABLES)(source)


def evidence_of(source: str) -> Column:
    """The first title (ASCII white space collapsed, spaces of any kind stripped), all h1, selected options."""

    def run(pages: pd.Series) -> pd.DataFrame:
        got = [_read(s, False) for s in pages]
        return pd.DataFrame({"title": [re.sub(r"[\t\n\f\r ]+", " ", r.title).strip(_SPACES) or None for r in got], "h1": [[" ".join(h.split()) for h in r.h1] for r in got], "selected": [r.options for r in got]})

    return F.pandas_udf(run, "struct<title string, h1 array<string>, selected array<string>>")(source)


def tables(pages: DataFrame, keys: list[str], source: str = "html") -> DataFrame:
    """One row per table: keys, pos, id, heading, hidden (in a comment), rows."""
    return pages.select(*keys, F.explode(tables_of(source)).alias("t")).select(*keys, "t.*")


def table_rows(found: DataFrame, keys: list[str]) -> DataFrame:
    """One row per table row with its cells."""
    return found.select(*keys, "pos", "heading", F.posexplode("rows").alias("row", "cells"))


def heading_direction(heading: Column) -> Column:
    word = F.regexp_extract(heading, r"^\s*(Arrivals|Departures)\b", 1)
    return F.when(word == "Arrivals", "in").when(word == "Departures", "out")


def heading_season(heading: Column) -> Column:
    """The first year of '15/16'."""
    yy = F.nullif(F.regexp_extract(heading, r"([0-9]{2})/[0-9]{2}", 1), F.lit("")).cast("int")
    return F.when(yy >= 50, 1900 + yy).otherwise(2000 + yy)


def transfer_rows(pages: DataFrame, keys: list[str], source: str = "html") -> DataFrame:
    """Transfers of Arrivals and Departures tables; a row has four cells: player, age, club, fee."""
    rows = table_rows(tables(pages, keys, source), keys).where((F.size("cells") >= 4) & (F.col("row") > 0))
    link = lambda part: href_id(F.array_join(F.flatten(F.transform("cells", lambda c: c["hrefs"])), " "), part)
    club = F.col("cells")[F.size("cells") - 2]
    f = fee(F.col("cells")[F.size("cells") - 1]["text"])
    return rows.select(
        *keys, "pos", "heading", heading_direction(F.col("heading")).alias("direction"), heading_season(F.col("heading")).alias("heading_season"),
        link("spieler").alias("player_id"), F.col("cells")[0]["text"].alias("player_name"), link("verein").alias("counterparty_club_id"), club["text"].alias("counterparty_club_name"),
        link("saison_id").alias("season_id"), f["amount"].alias("fee_amount"), f["type"].alias("fee_type"), internal_promotion(club["text"]).alias("is_internal_promotion"),
    )


def unresolved_tables(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Tables without an own heading, with one used twice, or whose season differs from their rows'."""
    per = rows.groupBy(*keys, "pos", "heading", "direction", "heading_season").agg(F.max("season_id").alias("season"), F.count("*").alias("rows"))
    from pyspark.sql import Window

    reused = F.count("*").over(Window.partitionBy(*keys, "heading")) > 1
    reason = F.when(F.col("direction").isNull(), "no heading").when(reused, "shared heading").when(F.col("season") != F.col("heading_season"), "season differs")
    return per.withColumn("reason", reason).where("reason is not null")


def require_resolved(rows: DataFrame, keys: list[str], first: int = 2000) -> DataFrame:
    """rows without those of unresolved tables; raises if one of them is from `first` on."""
    bad = unresolved_tables(rows, keys)
    recent = bad.where(F.col("season") >= first).limit(3).collect()
    if recent:
        raise ValueError(f"unresolved tables: {[(r.heading, r.reason) for r in recent]}")
    return rows.join(bad.select(*keys, "pos"), [*keys, "pos"], "left_anti")


def squad_rows(pages: DataFrame, keys: list[str], source: str = "html") -> DataFrame:
    """Rows of eight cells or more: player, position, date of birth, market value in millions."""
    from touchline.functions.core import money

    rows = table_rows(tables(pages, keys, source), keys).where((F.size("cells") >= 8) & (F.col("row") > 0))
    hrefs = F.array_join(F.flatten(F.transform("cells", lambda c: c["hrefs"])), " ")
    return rows.select(*keys, href_id(hrefs, "spieler").alias("player_id"), F.col("cells")[1]["text"].alias("player_name"), F.col("cells")[4]["text"].alias("position"), F.col("cells")[5]["text"].alias("born"), money(F.col("cells")[F.size("cells") - 1]["text"]).alias("market_value"))


def club_links(found: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, pos, club_id, club_name, first) per table: first-seen order, the first non-empty text wins."""
    cells = found.select(*keys, "pos", F.flatten("rows").alias("cells")).select(*keys, "pos", F.posexplode("cells").alias("at", "c"))
    links = cells.select(*keys, "pos", "at", F.posexplode(F.arrays_zip("c.hrefs", "c.link_texts")).alias("k", "l")).select(*keys, "pos", "at", "k", href_id(F.col("l.hrefs"), "verein").alias("club_id"), F.col("l.link_texts").alias("text")).where("club_id is not null")
    name = F.min(F.when(F.col("text") != "", F.struct("at", "k", "text")))
    return links.groupBy(*keys, "pos", "club_id").agg(name.alias("n"), F.min(F.struct("at", "k")).alias("first")).select(*keys, "pos", "club_id", F.col("n.text").alias("club_name"), "first")


def participants(links: DataFrame, keys: list[str], least: int = 5) -> DataFrame:
    """Of each page the table with most clubs, at least five, and the tables holding the very same ids."""
    per = links.groupBy(*keys, "pos").agg(F.array_sort(F.collect_set("club_id")).alias("clubs")).withColumn("n", F.size("clubs")).where(F.col("n") >= least)
    best = per.groupBy(*keys).agg(F.max_by(F.struct("pos", "clubs", "n"), F.struct("n", -F.col("pos"))).alias("b")).select(*keys, F.col("b.pos").alias("pos"), F.col("b.clubs").alias("clubs"), F.col("b.n").alias("n"))
    again = per.select(*keys, F.col("pos").alias("p2"), "clubs").join(best.select(*keys, "pos", "clubs"), [*keys, "clubs"]).where("p2 <> pos").select(*keys).distinct().withColumn("corroborated", F.lit(True))
    return best.join(again, keys, "left").withColumn("corroborated", F.coalesce("corroborated", F.lit(False)))


def expected_clubs(code: Column, season: Column) -> Column:
    return F.when(code == "L1", 18).when((code == "FR1") & (season >= 2023), 18).otherwise(20)


def accept_league(pages: DataFrame, keys: list[str], source: str = "html") -> DataFrame:
    """Each (code, season) page with the guards it passes: title, selector, heading, count, corroboration."""
    who = participants(club_links(tables(pages, keys, source), keys), keys)
    e = pages.select(*keys, evidence_of(source).alias("e"))
    label = F.concat(F.substring(F.col("season_id").cast("string"), 3, 2), F.lit("/"), F.lpad(((F.col("season_id") + 1) % 100).cast("string"), 2, "0"))
    out = e.join(who, keys, "left")
    guards = {
        "title_ok": F.contains(F.coalesce("e.title", F.lit("")), label),
        "selector_ok": F.exists("e.selected", lambda s: s == label),
        "heading_ok": F.exists("e.h1", lambda s: F.contains(s, label)),
        "count_ok": F.coalesce(F.col("n") == expected_clubs(F.col("league_code"), F.col("season_id")), F.lit(False)),
        "corroborated": F.coalesce("corroborated", F.lit(False)),
    }
    out = out.withColumns(guards)
    return out.withColumn("accepted", F.expr(" and ".join(guards))).drop("e")


def table_by_id(pages: DataFrame, keys: list[str], table_id: str, source: str = "html") -> DataFrame:
    """The table of that id, outside comments first."""
    from touchline.operators.tables import pick_best

    return pick_best(tables(pages, keys, source).where(F.col("id") == table_id), keys, [F.col("hidden").asc(), F.col("pos").asc()])
