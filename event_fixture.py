"""The generic `events` table read as an activity log: the input of tests, queries and bench.

`__spark_entry__.py` states the same mapping in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from playtrail.schema import ACTIVITY_COLUMNS

# How each column of an activity log is read off one row of `events`.
FROM_EVENTS = {
    "userId": """
        CASE WHEN event_id % 97 = 0 THEN ''
             WHEN event_id % 101 = 0 THEN NULL
             ELSE string(user_id) END""",
    "sessionId": """
        CASE WHEN event_id % 103 <> 0 THEN user_id * 100 + dayofmonth(timestamp(ts)) END""",
    "ts": "unix_millis(timestamp(ts))",
    "page": """
        CASE event_type
          WHEN 'error' THEN CASE WHEN value > 200 THEN 'Cancellation Confirmation'
                                 WHEN event_id % 2 = 0 THEN 'Roll Advert'
                                 ELSE 'Thumbs Down' END
          WHEN 'view' THEN 'NextSong'
          WHEN 'click' THEN if(event_id % 3 = 0, 'Thumbs Up', 'NextSong')
          WHEN 'purchase' THEN CASE event_id % 5 WHEN 0 THEN 'Submit Downgrade'
                                                 WHEN 1 THEN 'Downgrade'
                                                 ELSE 'Add to Playlist' END
          WHEN 'signup' THEN if(event_id % 2 = 0, 'Add Friend', 'Logout')
        END""",
    "level": "if(user_id % 3 = 0, 'paid', 'free')",
    "song": "if(isSong, 'song-' || string(event_id % 1000), NULL)",
    "artist": "if(isSong, 'artist-' || string(event_id % 100), NULL)",
    "gender": "if(user_id % 2 = 0, 'F', 'M')",
    "itemInSession": "event_id % 50",
    "length": "if(isSong, value, NULL)",
    "location": "'city-' || string(user_id % 20)",
    "status": "bigint(if(event_type = 'error', 404, 200))",
    "userAgent": "'agent-' || string(user_id % 5)",
}
IS_SONG = "event_type = 'view' OR (event_type = 'click' AND event_id % 3 <> 0) AS isSong"


def activity_from_events(events: DataFrame, *others: str) -> DataFrame:
    """Read the generic `events` table as an activity log, with other columns of it if named.

    Plain arithmetic on the event's own columns, so the same log can be stated
    in SQL. Some ids come out blank or null to give cleaning something to do.
    """
    columns = [f"{FROM_EVENTS[name]} AS {name}" for name in ACTIVITY_COLUMNS]
    return events.selectExpr("*", IS_SONG).selectExpr(*others, *columns)
