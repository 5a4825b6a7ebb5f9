"""Parsing and rules on hand-written logs."""

import datetime

import pytest
from pyspark.sql import functions as F

from tracewarden.operators import rules, stats
from tracewarden.operators.analysis import run_static_analysis
from tracewarden.sources import logs, sinks

AGENT = "Mozilla/5.0"


def line(ip, at, request, status, agent=AGENT, day="29/Nov/2025", referrer="-", tail=" 10"):
    return f'{ip} - - [{day}:{at} +0530] "{request} HTTP/1.1" {status} 128 "{referrer}" "{agent}"{tail}'


def frame(spark, lines):
    return spark.createDataFrame(list(enumerate(lines)), "seq long, line string")


def entries(spark, lines):
    return logs.parse_lines(frame(spark, lines))


def parse_one(spark, text):
    rows = entries(spark, [text]).collect()
    return rows[0] if rows else None


def test_parse_fields(spark):
    row = parse_one(spark, "\t " + line("10.0.0.1", "10:15:30", "GET /a?b=1", 200, referrer="http://x/") + " \r")
    assert (row.ip, row.method, row.endpoint, row.status, row.bytes_sent) == ("10.0.0.1", "GET", "/a?b=1", 200, 128)
    assert (row.referrer, row.user_agent, row.response_time) == ("http://x/", AGENT, 10)
    assert row.timestamp == "29/Nov/2025:10:15:30 +0530"
    assert row.dt == datetime.datetime(2025, 11, 29, 10, 15, 30)


@pytest.mark.parametrize("text", [
    "", "   ", "# comment", "  # comment",
    line("10.0.0.1", "10:15:30", "GET /a b", 200),
    "x " + line("10.0.0.1", "10:15:30", "GET /a", 200),
    line("10.0.0.1", "10:15:30", "GET /a", "abc"),
])
def test_lines_that_do_not_parse(spark, text):
    assert parse_one(spark, text) is None


def test_parse_edges(spark):
    assert parse_one(spark, line("1.1.1.1", "1:2:3", "GET /a", 200, tail="")).response_time == 0
    assert parse_one(spark, line("1.1.1.1", "1:2:3", "GET /a", 200, tail=" 7 trailing text")).response_time == 7
    assert parse_one(spark, line("1.1.1.1", "1:2:3", "GET /a", 200, tail=" n/a")).response_time == 0
    row = parse_one(spark, line("1.1.1.1", "1:2:3", 'GET /a"b]c', 200, agent="", referrer=""))
    assert (row.endpoint, row.referrer, row.user_agent) == ('/a"b]c', "", "")
    row = parse_one(spark, '1.1.1.1 - - [a "quoted" time] "GET /a HTTP/1.0" 200 5 "r]s" "u]v"')
    assert (row.timestamp, row.referrer, row.user_agent, row.dt) == ('a "quoted" time', "r]s", "u]v", None)


@pytest.mark.parametrize("stamp, expected", [
    ("9/NOV/2025:1:2:3", datetime.datetime(2025, 11, 9, 1, 2, 3)),
    ("29/Nov/2025:10:15:30 -0800", datetime.datetime(2025, 11, 29, 10, 15, 30)),
    ("30/Feb/2025:10:15:30 +0000", None),
    ("29/Foo/2025:10:15:30", None),
    ("2025-11-29 10:15:30", None),
])
def test_timestamps(spark, stamp, expected):
    assert parse_one(spark, f'1.1.1.1 - - [{stamp}] "GET /a HTTP/1.0" 200 5 "-" "u"').dt == expected


def test_scan_drops_bad_bytes_and_keeps_order(spark, tmp_path):
    for f in range(2):
        rows = [line(f"10.0.{f}.{i % 250}", "10:15:30", f"GET /{f}/{i}", 200) for i in range(400)]
        (tmp_path / f"part{f}.log").write_bytes(b"\n".join(r.encode() for r in rows) + "\na�b".encode() + b"\n/\xff\xfe\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        scanned = logs.log_scan(spark, str(tmp_path))
        assert scanned.filter(F.col("line") == "/").count() == 2
        assert scanned.filter(F.col("line") == "a�b").count() == 2  # a real one stays
        got = [r.endpoint for r in logs.parse_lines(scanned).orderBy("seq").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [f"/{f}/{i}" for f in range(2) for i in range(400)]


def test_parse_stats(spark):
    lines = frame(spark, ["# c", "", " ", "junk", line("1.1.1.1", "1:2:3", "GET /a", 200)])
    assert logs.parse_stats(lines).first().asDict() == {"total_lines": 5, "parsed_entries": 1, "parse_errors": 1}


def failed(ip, at, day="29/Nov/2025", path="/x/Login"):
    return line(ip, at, f"POST {path}", 401, day=day)


def test_brute_force_takes_file_order_and_whole_history(spark):
    close = [failed("1.0.0.1", f"10:00:{i:02d}") for i in range(0, 50, 10)]
    far = [failed("1.0.0.2", f"10:{i:02d}:00") for i in range(5)]
    # Out of order: last minus first is negative, which passes.
    back = [failed("1.0.0.3", f"1{4 - i}:00:00") for i in range(5)]
    few = [failed("1.0.0.4", "10:00:00")] * 4
    no_login = [failed("1.0.0.5", "10:00:00", path="/admin")] * 9
    unknown = [failed("1.0.0.6", "10:00:00", day="29/Foo/2025")] + [failed("1.0.0.6", "10:00:00")] * 5
    got = rules.brute_force(entries(spark, close + far + back + few + no_login + unknown)).orderBy("seq").collect()
    assert [(r.source_ip, r.description) for r in got] == [
        ("1.0.0.1", "5 failed login attempts in 40 seconds"),
        ("1.0.0.3", "5 failed login attempts in -14400 seconds"),
    ]
    assert got[0].evidence[0] == "1.0.0.1 [29/Nov/2025:10:00:00 +0530] POST /x/Login 401"
    assert got[0].timestamp == "29/Nov/2025:10:00:00 +0530" and len(got[0].evidence) == 5


@pytest.mark.parametrize("endpoint, sql, xss", [
    ("/a?q=UNION%20SELECT", False, False),
    ("/a?q=%27or%20", True, False),
    ("/a?q=1=1", True, False),
    ("/a;drop", True, False),
    ("/a?'x'y='z'", True, False),
    ("/a?<SCRIPT>", False, True),
    ("/a?onLoad=x", False, True),
    ("/a?<img/src=x/onerror", False, True),
    ("/a?javascript:x", False, True),
    ("/plain", False, False),
])
def test_patterns(spark, endpoint, sql, xss):
    e = entries(spark, [line("1.1.1.1", "10:00:00", f"GET {endpoint}", 200)])
    assert rules.sql_injection(e).count() == sql
    assert rules.xss(e).count() == xss


def test_pattern_with_blanks(spark):
    """Parsed endpoints hold no blanks, but the rule takes any table of entries."""
    e = entries(spark, [line("1.1.1.1", "10:00:00", "GET /a", 200)]).withColumn("endpoint", F.lit("/a?union  all select"))
    assert rules.sql_injection(e).count() == 1


def test_path_traversal_gate(spark):
    upper = [line("1.1.1.1", "10:00:00", "GET /ETC/PASSWD", 200), line("1.1.1.1", "10:00:00", "GET /windows/win.ini", 200)]
    assert rules.path_traversal(entries(spark, upper)).count() == 0
    # Any suspicious path opens the gate, even one that is no traversal.
    opened = entries(spark, upper + [line("1.1.1.2", "10:00:00", "GET /fetch", 200)])
    assert rules.path_traversal(opened).count() == 2
    assert rules.entry_threats(opened).filter("type = 'PATH_TRAVERSAL'").count() == 2
    dots = entries(spark, [line("1.1.1.1", "10:00:00", r"GET /a/..\b", 200)])
    assert rules.path_traversal(dots).count() == 1


def test_port_scan(spark):
    scan = [line("1.0.0.1", f"10:00:0{i // 4}", f"GET /p{9 - i}", 404) for i in range(9)]
    slow = [line("1.0.0.2", f"10:00:{i * 2:02d}", f"GET /p{i}", 404) for i in range(9)]
    same = [line("1.0.0.3", "10:00:00", "GET /p", 404)] * 20
    got = rules.port_scan(entries(spark, scan + slow + same)).collect()
    assert [(r.source_ip, r.description, r.evidence) for r in got] == [
        ("1.0.0.1", "Scanned 9 endpoints in 2 seconds", ["/p1", "/p2", "/p3", "/p4", "/p5"])]


def test_bursts_and_overload(spark):
    hits = [line(f"1.0.0.{i}", "10:00:00", "GET /hot", 200) for i in range(1, 8)]
    repeats = [line("1.0.0.1", "11:00:00", "GET /hot", 200)] * 9
    errors = [line("1.0.0.9", f"12:00:0{i}", "GET /e", 503) for i in range(4)]
    e = entries(spark, hits + repeats + errors)
    (burst,) = rules.burst(e).collect()
    assert burst.source_ip == "1.0.0.1,1.0.0.2,1.0.0.3,1.0.0.4,1.0.0.5"
    assert burst.description == "7 unique IPs hit /hot simultaneously"
    assert burst.evidence == ["Time: 2025-11-29 10:00:00", "Endpoint: /hot"]
    (overload,) = rules.overload(e).collect()
    assert overload.description == "4 service unavailable (503) errors detected" and len(overload.evidence) == 3
    assert overload.timestamp == "29/Nov/2025:12:00:00 +0530"
    assert rules.overload(entries(spark, errors[:2])).count() == 0


def test_off_hours(spark):
    e = entries(spark, [line("1.1.1.1", f"{h:02d}:30:00", "GET /Admin", 200) for h in (5, 6, 21, 22)])
    assert [r.description for r in rules.off_hours_admin(e).orderBy("seq").collect()] == [
        "Admin access at 05:00 (off-hours)", "Admin access at 22:00 (off-hours)"]


def test_attack_tools(spark):
    long_agent = "NIKTO/" + "x" * 80
    e = entries(spark, [line(f"1.0.0.{i % 4}", "10:00:00", "GET /", 200, agent=long_agent) for i in range(8)]
                + [line("1.0.0.9", "10:00:00", "GET /", 200, agent="curl 7")])
    (tool,) = rules.attack_tools(e).collect()
    assert tool.source_ip == "1.0.0.0,1.0.0.1,1.0.0.2"
    assert tool.description == "Detected attack tool: " + long_agent[:50]
    assert tool.evidence == ["Requests: 8", "IPs: 4"]


def test_empty_input(spark, tmp_path):
    e = entries(spark, ["# nothing"])
    assert rules.detect_all(e).count() == 0
    assert stats.log_summary(e).count() == 0
    assert stats.log_statistics(e).count() == 0
    path = tmp_path / "empty.log"
    path.write_text("# nothing\n")
    result = run_static_analysis(spark, str(path))
    assert result.message.startswith("Failed to parse") and result.threats.count() == 0


def test_rules_that_cannot_fit_do_not_run(spark, monkeypatch):
    e = entries(spark, [failed("1.0.0.1", f"10:00:0{i}") for i in range(6)]
                + [line("1.0.0.2", "03:00:00", "GET /usr/admin?q=<script>", 200, agent="sqlmap/1")])
    everything = rules.detect_all(e).collect()
    assert {r.type for r in everything} == {"BRUTE_FORCE", "XSS", "OFF_HOURS_ADMIN", "SUSPICIOUS_TOOL"}
    for kind, severity in {(r.type, r.severity) for r in everything}:
        assert (kind, severity) in {x for raised, _ in rules.RULES for x in raised}
        one = rules.detect_all(e, kind=kind).collect()
        assert one == [r for r in everything if r.type == kind]
        assert rules.detect_all(e, severity=severity).count() == sum(r.severity == severity for r in everything)
    assert rules.detect_all(e, kind="DDOS").count() == 0 and rules.detect_all(e, severity="LOW").count() == 0
    ran = []
    monkeypatch.setattr(rules, "RULES", [(raised, lambda e, cfg, f=f, r=raised: ran.append(r) or f(e, cfg)) for raised, f in rules.RULES])
    rules.detect_all(e, kind="DDOS_INDICATOR")
    assert ran == [{("DDOS_INDICATOR", "HIGH")}]


def test_analysis_of_a_file(spark, tmp_path):
    path = tmp_path / "access.log"
    path.write_text("\n".join(
        ["# header", ""] + [failed("1.0.0.1", f"10:00:0{i}") for i in range(6)]
        + [line("1.0.0.2", "03:00:00", "GET /usr/admin/", 200), line("1.0.0.2", "03:00:01", "GET /usr/admin", 200)]
        + [line("1.0.0.3", "12:00:00", "GET /../../etc/passwd", 403, agent="sqlmap/1"), "broken"]) + "\n")
    result = run_static_analysis(spark, str(path))
    kinds = {r.type: r["count"] for r in result.threats.groupBy("type").count().collect()}
    assert kinds == {"BRUTE_FORCE": 1, "OFF_HOURS_ADMIN": 2, "PATH_TRAVERSAL": 1, "SUSPICIOUS_TOOL": 1}
    facts = {(r.metric, r.key): r.value for r in result.statistics.collect()}
    assert facts["unique_endpoints", ""] == 3 and facts["graph_nodes", ""] == 7
    assert facts["parse_errors", ""] == 1 and facts["total_lines", ""] == 12
    summary = {r.metric: r.value for r in result.summary.collect()}
    assert summary["total_threats"] == 5 and summary["unique_attackers"] == 3 and summary["low_count"] == 0
    report = [r.text for r in sinks.threat_report(result.threats, result.statistics)
              .orderBy("section", "rule_ord", "seq").collect()]
    assert "Total Threats Detected: 5" in report[0] and report[1].startswith("[HIGH] BRUTE_FORCE from 1.0.0.1")
    assert report[1].count("Evidence") == 3 and report[1].endswith("...\n")
    assert report[6].split("\n")[1] == "STATISTICS:" and report[-1] == "=" * 60
    without = [r.text for r in sinks.threat_report(result.threats).orderBy("section", "rule_ord", "seq").collect()]
    assert without == [*report[:6], report[-1]]
    sinks.write_threats(result.threats, str(tmp_path / "out"), "json")
    assert spark.read.json(str(tmp_path / "out")).count() == 5
