"""Flat maps by table functions, called from SQL and from DataFrames."""

import ordinate as o
from ordinate.plans.registry import query


def _lines(text):
    """The lines of a text that are not empty, with their places among all lines."""
    for place, line in enumerate((text or "").split("\n")):
        if line:
            yield place, len(line), line[:1]


@query("""
SELECT doc_id, CAST(place AS INTEGER) AS place, CAST(length(line) AS INTEGER) AS chars, substr(line, 1, 1) AS first
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS place FROM documents)
WHERE line <> ''
""")
def flat_map_lateral(t):
    """Lines of whole texts, by a function that SQL calls beside each document."""
    o.register_functions(t.spark, {"ordinate_lines": o.row_function(_lines, "place int, chars int, first string")})
    documents = t.documents.select("doc_id", "text")
    return t.spark.sql(
        "SELECT doc_id, place, chars, first FROM {documents} AS d, LATERAL ordinate_lines(d.text)", documents=documents)


#: seconds of quiet that end a session
_QUIET = 24 * 3600


def _visit(session, row):
    """Hold the session that a row belongs to; give the one before it when it has ended."""
    if session and (row["ts"] - session["last"]).total_seconds() > _QUIET:
        yield _session(session)
        session.update(number=session["number"] + 1, first=row["event_id"], n=0)
    elif not session:
        session.update(user=row["user_id"], number=0, first=row["event_id"], n=0)
    session.update(last=row["ts"], n=session["n"] + 1)


def _session(session):
    return session["user"], session["number"], session["first"], session["n"]


@query(f"""
WITH g AS (SELECT *, ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS quiet FROM events),
     s AS (SELECT *, sum(CASE WHEN quiet > INTERVAL '{_QUIET} seconds' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM g)
SELECT user_id, CAST(session AS BIGINT) AS session, arg_min(event_id, (ts, event_id)) AS first_event, count(*) AS n FROM s GROUP BY 1, 2
""")
def flat_map_sessions(t):
    """Sessions of users, by a function with a state for each."""
    sessions = o.table_function(
        _visit, "user_id bigint, session bigint, first_event bigint, n bigint", start=dict, finish=lambda session: [_session(session)])
    return o.flat_map_table(t.events.select("user_id", "ts", "event_id"), sessions, "user_id", ["ts", "event_id"])
