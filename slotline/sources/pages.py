"""Rows of archived HTML reports, one page at a time inside tasks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from slotline.functions.scalars import clock_seconds, described_team, optional_team, report_clock, report_event_type

_ROW = re.compile(r"<tr[^>]*class=[\"']?[^\"'>]*(?:evenColor|oddColor)[^>]*>(.*?)</tr>", re.I | re.S)
_CELL = re.compile(r"<td[^>]*>(.*?)</td>", re.I | re.S)
_PRE = re.compile(r"<pre[^>]*>(.*?)</pre>", re.I | re.S)
_TAG = re.compile(r"<[^>]*>")
#: Columns of the fixed-width form: fixed values.
SLICES = ((0, 5), (5, 10), (10, 16), (16, 32), (32, 38), (38, 42), (42, None))
#: Rows of a report that a task holds before it passes them on.
HELD_ROWS = 4096


def _text(cell: str) -> str:
    return " ".join(unescape(_TAG.sub(" ", cell)).split())


def report_rows(html: str) -> tuple[str, list[list[str]]]:
    """A report's form and rows of cells: marked table rows of six cells or more, else the first block's fixed-width lines."""
    rows = [[_text(c) for c in _CELL.findall(r)] for r in _ROW.findall(html)]
    rows = [r for r in rows if len(r) >= 6]
    if rows:
        return "table", rows
    block = _PRE.search(html)
    lines = unescape(_TAG.sub("", block[1])).splitlines() if block else []
    return "lines", [[x[a:b].strip() for a, b in SLICES] for x in lines if len(x) > SLICES[-1][0] and x.isascii()]


def report_batches(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """A task's (key, form, row, cells) from its (key, html), passed on whenever ``HELD_ROWS`` are there."""
    held: list[tuple] = []

    def sent() -> pa.RecordBatch:
        types = [kept, pa.string(), pa.int32(), pa.list_(pa.string())]
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in held], t) for i, t in enumerate(types)], [key, "form", "row", "cells"])

    for batch in batches:
        kept = batch.schema.field(0).type
        for k, h in zip(batch.column(0), batch.column(1), strict=True):
            form, rows = report_rows(h.as_py() or "")
            own = k.as_py()
            held += [(own, form, i, r) for i, r in enumerate(rows)]
            if len(held) >= HELD_ROWS:
                yield sent()
                held.clear()
    if held:
        yield sent()


def extract_report_rows(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, form, row, cells): every report row of every page; pages without any give none."""
    slim = pages.select(key, html)
    kind = slim.schema[key].dataType.simpleString()
    return slim.mapInArrow(lambda batches: report_batches(batches, key), f"{key} {kind}, form string, row int, cells array<string>")


def report_events(rows: DataFrame, key: str = "page_id") -> DataFrame:
    """Typed report rows: id, period, clock, event type, team, strength, description; rows that don't parse are dropped."""
    cell = lambda k: F.try_element_at("cells", F.lit(k + 1))
    table = F.col("form") == "table"
    pick = lambda a, b: F.when(table, cell(a)).otherwise(cell(b))
    strength = F.lower(pick(2, 5))
    typed = rows.select(
        key, "row", cell(0).try_cast("int").alias("report_event_id"), cell(1).try_cast("int").alias("period"),
        report_clock(F.when(table, F.try_element_at(F.split(cell(3), " "), F.lit(1))).otherwise(cell(2))).alias("clock"),
        report_event_type(pick(4, 3)).alias("event_type"),
        F.when(table, described_team(cell(5))).otherwise(optional_team(cell(4))).alias("team"),
        F.when(strength.isin("pp", "sh", "ev"), strength).alias("strength"), pick(5, 6).alias("description"),
    )
    return typed.dropna(subset=["report_event_id", "period", "clock", "event_type"])


#: Elements without an end tag: fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source wbr".split())
_MORE = r"""[^<>"']*+(?:(?:"[^"]*+"|'[^']*+')[^<>"']*+)*+>"""
_FLAT_CELL = re.compile(rf"(<td{_MORE})([^<]*+)</td>")
#: A tag of a page without quotes that stay open; texts between tags have no ``<``.
_MARKUP = re.compile(rf"(<[/a-zA-Z]{_MORE})")
_INLINE = rf"<td{_MORE}[^<]*+(?:</?[a-su-zA-SU-Z]{_MORE}[^<]*+)*+</td>"
_INLINE_CELL = re.compile(_INLINE)
_INNER = re.compile(rf"(<td{_MORE})(<table{_MORE})(<tr{_MORE})")
#: The same, or whole: a row of cells that hold text only, a cell without a table's tags, a cell that holds a table of one row of these.
_ROWS = re.compile(rf"(<tr{_MORE}(?:<td{_MORE}[^<]*+</td>)++</tr>|{_INLINE}|<td{_MORE}<table{_MORE}<tr{_MORE}(?:{_INLINE})*+</tr></table></td>|<[/a-zA-Z]{_MORE})")


#: Kinds of what comes one after the other on a page.
TEXT, CELL, ROW, BREAK, OTHER, END, FLAT, WHOLE, INNER = range(9)
_Part = tuple[int, str, list | str | None]


class _Parts(HTMLParser):
    """Texts and tags of some markup: (kind, text or name, classes of cells and rows or the title of others)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[_Part] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        named = dict(attrs)
        if tag in ("td", "th", "tr"):
            self.parts.append((ROW if tag == "tr" else CELL, tag, (named.get("class") or "").split()))
        elif tag not in VOID:
            self.parts.append((OTHER, tag, named.get("title")))
        elif tag == "br":
            self.parts.append((BREAK, tag, None))

    def handle_endtag(self, tag: str) -> None:
        self.parts.append((END, tag, None))

    def handle_data(self, data: str) -> None:
        self.parts.append((TEXT, data, None))


@lru_cache(maxsize=1 << 14)
def _tag(markup: str) -> list[_Part] | None:
    """What a tag's markup is by itself; None if the parser would go on reading."""
    reader = _Parts()
    reader.feed(markup)
    return None if reader.rawdata or reader.cdata_elem is not None else reader.parts


def _plain(text: str) -> str:
    return unescape(text) if "&" in text else text


def _flat(markup: str) -> _Part | None:
    """A row of cells that hold text only; None if its tags aren't what they look like."""
    start = _tag(markup[: markup.index("<td")])
    cells = [(_tag(tag), _plain(text)) for tag, text in _FLAT_CELL.findall(markup)]
    if not start or len(start) > 1 or start[0][0] != ROW or any(not t or len(t) > 1 or t[0][1] != "td" or t[0][0] != CELL for t, _ in cells):
        return None
    return FLAT, markup, [start[0][2], [[t[0][2], text, []] for t, text in cells]]


@lru_cache(maxsize=1 << 14)
def _whole(markup: str) -> list[_Part] | None:
    """A cell as one part, or its texts and tags where these open or close anything around it; None if a tag can't stand by itself."""
    pieces = _MARKUP.split(markup)
    parts: list[_Part] = []
    for text, tag in zip(pieces[::2], [*pieces[1::2], None], strict=True):
        if text:
            parts.append((TEXT, _plain(text), None))
        if tag is not None:
            found = _tag(tag)
            if found is None:
                return None
            parts += found
    inside = []
    for kind, name, _ in parts[1:-1]:
        if kind == OTHER:
            inside.append(name)
        elif kind not in (TEXT, BREAK) and (kind != END or not inside or inside.pop() != name):
            return parts
    if inside or parts[0][:2] != (CELL, "td") or parts[-1][:2] != (END, "td"):
        return parts
    return [(WHOLE, markup, _read([(ROW, "tr", []), *parts])[0][1][0])]


def _inner(markup: str) -> _Part | None:
    """A cell that holds a table of one row of whole cells; None if its tags aren't what they look like."""
    start = _INNER.match(markup)
    cells = []
    for text in _INLINE_CELL.findall(markup, start.end()):
        found = _whole(text)
        if not found or found[0][0] != WHOLE:
            return None
        cells.append(found[0][2])
    tags = [_tag(t) for t in start.groups()]
    if not all(tags) or [len(t) for t in tags] != [1, 1, 1]:
        return None
    (cell,), (table,), (row,) = tags
    if cell[:2] != (CELL, "td") or table != (OTHER, "table", None) or row[0] != ROW:
        return None
    return INNER, markup, [row[2], cells, [cell[2], "".join([c[1] for c in cells]), [m for c in cells for m in c[2]]]]


def _parts(html: str, markup: re.Pattern = _ROWS) -> list[_Part]:
    """A page's texts and tags.

    Reports repeat few tags and cells very often, so each is parsed once, and a
    row of cells that hold text only is one part, as is a cell without a table or
    with one of one row. A page on which that doesn't hold, with comments, scripts or broken tags,
    is parsed as a whole.
    """
    pieces = markup.split(html)
    parts: list[_Part] = []
    tags = pieces[1::2]
    if "<" not in "".join(pieces[::2]):
        for text, tag in zip(pieces[::2], [*tags, None], strict=True):
            if text:
                parts.append((TEXT, _plain(text), None))
            if tag is None:
                return parts
            row = _flat(tag) if tag.startswith("<tr") and tag.endswith("</tr>") and markup is _ROWS else None
            if row is not None:
                parts.append(row)
                continue
            if len(tag) < 6 or not tag.endswith("</td>"):
                found = _tag(tag)
            elif tag.endswith("</table></td>"):
                inner = _inner(tag)
                found = _parts(tag, _MARKUP) if inner is None else [inner]
            else:
                found = _whole(tag)
            if found is None:
                break
            parts += found
    reader = _Parts()
    reader.feed(html)
    reader.close()
    return reader.parts


def table_rows(html: str) -> list[tuple[list[str], list[list]]]:
    """All table rows of a page in the order of their start: (classes, cells of (classes, text, marks)).

    Rows have their own cells, whatever tables lie inside these. A cell's text
    holds that of tables inside it; its marks are the (title, text) of the titled
    elements inside it. One pass: text goes to the innermost open cell or element
    only, and to the ones around when these close. Cells and rows that a page
    leaves open close where their table's next one begins.
    """
    return _read(_parts(html))


def _read(parts: list[_Part]) -> list[tuple[list[str], list[list]]]:
    """The table rows of a page's texts and tags."""
    rows: list[tuple[list[str], list[list]]] = []
    # of an open tag: name, its cell or title, pieces of text and marks if these are asked for, a table's surroundings
    opened: list[tuple] = []
    cell = row = -1  # where the current table's cell and row are open
    cells: list = []

    def close(at: int) -> None:
        nonlocal cell, row, cells
        while len(opened) > at:
            name, own, pieces, marks, around = opened.pop()
            if around is not None:
                cell, row, cells = around
            if pieces is not None:
                text = pieces[0] if len(pieces) == 1 else "".join(pieces)
                if own.__class__ is list:
                    own[1], own[2] = text, marks
                elif own is not None:
                    marks = [(own, text), *marks]
                if opened and opened[-1][2] is not None:
                    opened[-1][2].append(text)
                    opened[-1][3].extend(marks)
        if cell >= at:
            cell = -1
        if row >= at:
            row = -1

    def take(parts: list[_Part]) -> None:
        nonlocal cell, row, cells
        for kind, name, more in parts:
            if kind == TEXT:
                if opened and opened[-1][2] is not None:
                    opened[-1][2].append(name)
            elif kind == FLAT:
                if row >= 0:
                    close(row)
                if cell >= 0:  # a cell without a row is open
                    take(_parts(name, _MARKUP))
                    continue
                rows.append((more[0], more[1]))
                if opened and opened[-1][2] is not None:
                    opened[-1][2].extend([c[1] for c in more[1]])
            elif kind == WHOLE or kind == INNER:
                if cell >= 0:
                    close(cell)
                if row < 0:  # a cell of no row
                    take(_parts(name, _MARKUP))
                    continue
                if kind == INNER:
                    rows.append((more[0], more[1]))
                    more = more[2]
                cells.append(more)
                if opened[-1][2] is not None:
                    opened[-1][2].append(more[1])
                    opened[-1][3].extend(more[2])
            elif kind == END:
                for i in range(len(opened) - 1, -1, -1):
                    if opened[i][0] == name:
                        close(i)
                        break
                    if opened[i][0] == "table" and name not in ("html", "body"):
                        break  # an end tag inside a cell's table closes nothing around it
            elif kind == CELL:
                if cell >= 0:
                    close(cell)
                own = None
                if row >= 0 and name == "td":
                    own = [more, "", []]
                    cells.append(own)
                cell = len(opened)
                asked = own is not None or (opened and opened[-1][2] is not None)
                opened.append((name, own, [], [], None) if asked else (name, None, None, None, None))
            elif kind == ROW:
                if row >= 0:
                    close(row)
                row, cells = len(opened), []
                rows.append((more, cells))
                asked = opened and opened[-1][2] is not None
                opened.append((name, None, [], [], None) if asked else (name, None, None, None, None))
            elif kind == OTHER:
                around = (cell, row, cells) if name == "table" else None
                asked = more is not None or (opened and opened[-1][2] is not None)
                opened.append((name, more, [], [], around) if asked else (name, None, None, None, around))
                if around is not None:
                    cell = row = -1
            elif opened and opened[-1][2] is not None:
                opened[-1][2].append(" ")

    take(parts)
    close(0)
    return rows


_CELLS = "array<struct<classes: array<string>, text: string, marks: array<struct<title: string, text: string>>>>"


def _lists(parts: list[list]) -> tuple[pa.Array, list]:
    """Offsets of some lists, and what they hold one after the other."""
    return pa.array([0, *accumulate(map(len, parts))], pa.int32()), [x for p in parts for x in p]


def _cells_array(rows: list[list]) -> pa.Array:
    """Rows' cells as one column, built from flat columns."""
    of_rows, cells = _lists(rows)
    of_classes, classes = _lists([c[0] for c in cells])
    of_marks, marks = _lists([c[2] for c in cells])
    flat = lambda texts: pa.array([" ".join(t.split()) for t in texts], pa.string())
    marked = pa.StructArray.from_arrays([pa.array([m[0] for m in marks], pa.string()), flat([m[1] for m in marks])], ["title", "text"])
    columns = [pa.ListArray.from_arrays(of_classes, pa.array(classes, pa.string())), flat([c[1] for c in cells]), pa.ListArray.from_arrays(of_marks, marked)]
    return pa.ListArray.from_arrays(of_rows, pa.StructArray.from_arrays(columns, ["classes", "text", "marks"]))


def extract_table_rows(pages: DataFrame, key: str = "page_id", html: str = "html", *, n_cells: int | None = None) -> DataFrame:
    """(key, row, classes, cells): every table row of every page, in order, with its own cells' classes, text and titled marks.

    With ``n_cells`` only rows of that many cells, numbered among all; the others don't leave the reader.
    """
    slim = pages.select(key, html)
    kind = slim.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sent() -> pa.RecordBatch:
            of, classes = _lists([r[2] for r in held])
            columns = [pa.array([r[0] for r in held], kept), pa.array([r[1] for r in held], pa.int32()), pa.ListArray.from_arrays(of, pa.array(classes, pa.string()))]
            return pa.RecordBatch.from_arrays([*columns, _cells_array([r[3] for r in held])], [key, "row", "classes", "cells"])

        held: list[tuple] = []
        for batch in batches:
            kept = batch.schema.field(0).type
            for k, h in zip(batch.column(0), batch.column(1), strict=True):
                k = k.as_py()
                held += [(k, i, classes, cells) for i, (classes, cells) in enumerate(table_rows(h.as_py() or "")) if n_cells is None or len(cells) == n_cells]
                if len(held) >= HELD_ROWS:
                    yield sent()
                    held = []
        if held:
            yield sent()

    return slim.mapInArrow(run, f"{key} {kind}, row int, classes array<string>, cells {_CELLS}")


def extract_toi_rows(rows: DataFrame, key: str = "page_id") -> tuple[DataFrame, DataFrame]:
    """Shift rows of time-on-ice reports, from ``extract_table_rows``, and the rows that can't be read with the reason.

    A row with a ``playerHeading`` cell names the player, by jersey, of the rows
    after it. Marked rows of seven cells without a `` / `` are summaries of
    periods; others have six cells: number, period (OT is 4), start and end as
    ``elapsed / left``, duration. Start, end and duration have to agree.
    """
    heading = F.try_element_at(F.filter("cells", lambda c: F.array_contains(c["classes"], "playerHeading")), F.lit(1))["text"]
    text = lambda i: F.try_element_at("cells", F.lit(i + 1))["text"]
    clock = lambda c: clock_seconds(F.trim(F.substring_index(c, " / ", 1)))
    summary = (F.size("cells") == 7) & ~F.exists("cells", lambda c: c["text"].contains(" / "))
    # everything is read before rows are sorted, so that numbers are sorted, not cells
    read = rows.select(
        key, "row", heading.alias("_head"), (F.arrays_overlap("classes", F.array(F.lit("oddColor"), F.lit("evenColor"))) & ~summary).alias("_shift"),
        F.size("cells").alias("_n"), text(0).try_cast("int").alias("shift_number"), F.when(text(1) == "OT", 4).otherwise(text(1).try_cast("int")).alias("period"),
        clock(text(2)).alias("start_s"), clock(text(3)).alias("end_s"), clock_seconds(F.trim(text(4))).alias("duration_s"),
    )
    said = F.when(F.col("_head").isNotNull(), F.struct(F.regexp_extract("_head", r"^([0-9]+)", 1).try_cast("int").alias("n")))
    so_far = Window.partitionBy(key).orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    read = read.withColumn("_said", said).drop("_head").withColumn("jersey", F.last("_said", ignorenulls=True).over(so_far)["n"]).where("_shift")
    read = read.select(key, "row", "jersey", "_n", "shift_number", "period", "start_s", "end_s", "duration_s")
    bad = lambda c: F.coalesce(c, F.lit(True))
    reason = (
        F.when(F.col("_n") != 6, "unrecognized_row").when(F.col("jersey").isNull(), "no_player").when(F.col("shift_number").isNull() | bad(F.col("period") < 1), "unreadable_number")
        .when(bad((F.col("start_s") > F.col("end_s")) | (F.col("end_s") > 1200) | (F.col("end_s") - F.col("start_s") != F.col("duration_s"))), "incoherent_interval")
    )
    judged = read.withColumn("reason", reason)
    return judged.where("reason IS NULL").drop("_n", "reason"), judged.where("reason IS NOT NULL").select(key, "row", "reason")


def extract_on_ice_rows(rows: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, report_event_id, period, sec, event_type, side, jersey, role): who was on the ice at each event of modern play-by-play reports.

    Marked rows of eight cells: number, period, strength, ``elapsed left``, type,
    description, and the away and the home players as elements titled ``position
    - name``. Rows of no known type are left out.
    """
    marked = rows.where(F.arrays_overlap("classes", F.array(F.lit("oddColor"), F.lit("evenColor"))) & (F.size("cells") == 8))
    text = lambda i: F.element_at("cells", i + 1)["text"]
    side = lambda name, i: F.struct(F.lit(name).alias("side"), F.element_at("cells", i + 1)["marks"].alias("marks"))
    # an event is read before its players are rows, so that it is read once
    typed = marked.select(
        key, text(0).try_cast("int").alias("report_event_id"), text(1).try_cast("int").alias("period"), clock_seconds(F.try_element_at(F.split(text(3), " "), F.lit(1))).alias("sec"),
        report_event_type(text(4)).alias("event_type"), F.array(side("away", 6), side("home", 7)).alias("_sides"),
    )
    event = [key, "report_event_id", "period", "sec", "event_type"]
    sides = typed.dropna(subset=event[1:]).select(*event, F.explode("_sides").alias("s"))
    players = sides.select(*event, F.col("s.side").alias("side"), F.explode("s.marks").alias("m"))
    role = F.when(F.col("m.title").startswith("Goalie -"), "goalie").otherwise("skater")
    return players.select(*event, "side", F.col("m.text").try_cast("int").alias("jersey"), role.alias("role"))


def on_ice_rows(rows: DataFrame, roster: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Report rows (game_id, side, jersey, ...) with player ids by jersey, and jerseys that aren't unique or known."""
    unique = roster.groupBy("game_id", "side", "jersey").agg(F.count("*").alias("_n"), F.max("player_id").alias("player_id"))
    both = rows.join(unique, ["game_id", "side", "jersey"], "left")
    good = F.coalesce(F.col("_n") == 1, F.lit(False))
    return both.where(good).drop("_n"), both.where(~good).select("game_id", "side", "jersey", "_n")
