"""Tables of report pages."""

from __future__ import annotations

import random

import pyarrow as pa

from slotline.sources import pages


def test_rows_have_their_own_cells_whatever_lies_inside():
    html = (
        '<table><tr class="a b"><td>x<table><tr><td class=c>in<font title="Goalie - P">3</font><td>more</table>y</td><td>z<br>w</td></tr>'
        '<tr><th>head<td><p title="t">un<b>closed</b><tr class=d><td>last &amp; <font title="Center - Q"> 4 </font></table></div>after'
    )
    got = [(c, [(k, " ".join(t.split()), [(a, b.strip()) for a, b in m]) for k, t, m in cells]) for c, cells in pages.table_rows(html)]
    assert got == [
        (["a", "b"], [([], "xin3morey", [("Goalie - P", "3")]), ([], "z w", [])]),
        ([], [(["c"], "in3", [("Goalie - P", "3")]), ([], "more", [])]),
        ([], [([], "unclosed", [("t", "unclosed")])]),
        (["d"], [([], "last & 4", [("Center - Q", "4")])]),
    ]
    assert pages.table_rows("") == [] and pages.table_rows("<td>no row</td>text</tr>") == []
    deep = pages.table_rows("<table><tr><td>" * 300 + "x")
    assert len(deep) == 300 and all(cells[0][1] == "x" for _, cells in deep)


def test_toi_reports(spark):
    row = lambda *c: "<tr class='oddColor'>" + "".join(f"<td>{x}</td>" for x in c) + "</tr>"
    good = row(1, 1, "0:10 / 19:50", "0:55 / 19:05", "0:45", "G")
    html = [
        row(9, 1, "0:10 / 19:50", "0:55 / 19:05", "0:45", "") + "<tr><td class='playerHeading x'>12 DOE, JO</td></tr>" + good + row(2, "OT", "5:00 / 0:00", "5:00 / 0:00", "0:00", ""),
        "<tr><td class='playerHeading'>7 A</td></tr>" + row(1, "x", "0:10 / 1", "0:20 / 1", "0:10", "") + row(1, 1, "0:20 / 1", "0:10 / 1", "0:10", "") + row(1, 1, "0:10 / 1", "bad", "0:10", "")
        + row(1, 2, "0:00", "1:00", "1:00", "2", "3") + row(1, 2) + "<tr><td class='playerHeading'>no number</td></tr>" + good,
        None,
    ]
    df = spark.createDataFrame(list(enumerate(html)), "page_id int, html string")
    shifts, problems = pages.extract_toi_rows(pages.extract_table_rows(df))
    assert [(r.jersey, r.shift_number, r.period, r.start_s, r.end_s) for r in shifts.orderBy("page_id", "row").collect()] == [(12, 1, 1, 10, 55), (12, 2, 4, 300, 300)]
    assert [(r.page_id, r.reason) for r in problems.orderBy("page_id", "row").collect()] == [
        (0, "no_player"), (1, "unreadable_number"), (1, "incoherent_interval"), (1, "incoherent_interval"), (1, "unrecognized_row"), (1, "no_player")]


def test_on_ice_reports(spark):
    side = lambda *p: "<td><table><tr>" + "".join(f'<td><font title="{t} - X">{n}</font><br>C</td>' for t, n in p) + "</tr></table></td>"
    row = "<tr class='evenColor'><td>5</td><td>2</td><td>EV</td><td>3:07<br>16:53</td><td>FAC</td><td>words</td>" + side(("Goalie", 30), ("Center", 9)) + side(("Defense", 4)) + "</tr>"
    df = spark.createDataFrame([(1, "<table>" + row + row.replace("FAC", "XXX") + row.replace("3:07", "x") + "</table>")], "page_id int, html string")
    got = pages.extract_on_ice_rows(pages.extract_table_rows(df)).collect()
    assert [(r.report_event_id, r.period, r.sec, r.event_type, r.side, r.jersey, r.role) for r in got] == [
        (5, 2, 187, "faceoff", "away", 30, "goalie"), (5, 2, 187, "faceoff", "away", 9, "skater"), (5, 2, 187, "faceoff", "home", 4, "skater")]


def test_report_rows_leave_a_task_in_small_batches():
    row = "<tr class=evenColor>" + "<td>1</td>" * 6 + "</tr>"
    batch = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array([row * 100] * 299 + [None])], ["page_id", "html"])
    out = list(pages.report_batches(iter([batch, batch]), "page_id"))
    assert sum(b.num_rows for b in out) == 2 * 29_900 and max(b.num_rows for b in out) < pages.HELD_ROWS + 100
    assert out[0].column(0).to_pylist()[:101] == [0] * 100 + [1] and out[0].column(2).to_pylist()[:100] == list(range(100))


def test_rows_read_by_memoised_tags_are_those_of_the_whole_parse():
    """Flat rows and memoised tags against the same reader fed by one parse of the page; a long report has few parts."""
    rng = random.Random(4)
    bits = [
        "<tr class='r'><td class=x>a &lt; b</td><td>c</td></tr>", "<tr><td title=q>1</td></tr>", "<tr>", "</tr>", "<td>", "</td>", "<th>", "<table>", "</table>", "x", "<br>",
        '<font title="T - u">', "</font>", "</html>", "</div>", "<td/>", "<font title=it's>", "<!-- c -->", "<script>", "</script>", "<", "<p title='a>b'>", '<td class="', "<title>",
    ]

    def whole(html):
        reader = pages._Parts()
        reader.feed(html)
        reader.close()
        return reader.parts

    fast = pages._parts
    for n in range(4000):
        html = "".join(rng.choice(bits[: 17 if n % 2 else None]) for _ in range(rng.randint(1, 30)))
        got = pages.table_rows(html)
        try:
            pages._parts = lambda h, *_: whole(h)
            assert pages.table_rows(html) == got, html
        finally:
            pages._parts = fast
    row = "<tr class='oddColor'><td>1</td><td>0:10 / 19:50</td></tr>"
    assert len(fast("<table>" + row * 1000 + "</table>")) == 1002


def test_cells_read_as_one_part_are_those_of_the_whole_parse():
    """Cells with marks, and cells with a table of one row of them, against one parse of the page; a report of line-ups has few parts."""
    rng = random.Random(9)
    mark = '<td align=c><font title="Center - P">7</font><br>C &amp; D</td>'
    inner = f'<td class="o"><table><tr class="n">{mark}{mark}</tr></table></td>'
    bits = [
        mark, inner, inner.replace(mark, ""), inner.replace("<table>", "<table title='t'>"), inner.replace("</font>", ""), mark.replace("<font", "<b></i><font"), "<td><p title='a'>x</p></p></td>",
        "<td/><table><tr></tr></table></td>", "<td>5</td>", "<td><a>x</td>", "<tr>", "<tr class=m>", "</tr>", "<table>", "</table>", "<td>", "</td>", "<p title='q'>", "</p>", "y", "<TD>", "<br>",
        "<td><script>x</td></script></td>", "<td><textarea><b></td>", "<td title='z'>w</td>",
    ]

    def whole(html):
        reader = pages._Parts()
        reader.feed(html)
        reader.close()
        return reader.parts

    fast = pages._parts
    for n in range(6000):
        html = "".join(rng.choice(bits[: 22 if n % 2 else None]) for _ in range(rng.randint(1, 25)))
        got = pages.table_rows(html)
        try:
            pages._parts = lambda h, *_: whole(h)
            assert pages.table_rows(html) == got, html
        finally:
            pages._parts = fast
    row = f"<tr class='evenColor'><td>1</td><td>3:07<br>16:53</td>{inner}{inner}</tr>"
    assert len(fast("<table>" + row * 100 + "</table>")) == 602


def test_rows_of_other_lengths_do_not_leave_the_reader(spark):
    html = "<table><tr class='evenColor'><td>1</td><td><table><tr><td>x</td></tr></table></td></tr><tr><td>2</td></tr><tr class=q><td>3</td><td>4</td></tr></table>"
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    every, some = pages.extract_table_rows(df), pages.extract_table_rows(df, n_cells=2)
    assert every.count() == 4 and some.orderBy("row").collect() == every.where("size(cells) = 2").orderBy("row").collect()
    assert [r.row for r in some.orderBy("row").collect()] == [0, 3]
