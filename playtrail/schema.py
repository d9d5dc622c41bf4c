"""Column names, types and fixed vocabulary of the activity log."""

from __future__ import annotations

from pyspark.sql import types as T

ACTIVITY = T.StructType(
    [
        T.StructField("userId", T.StringType()),
        T.StructField("sessionId", T.LongType()),
        T.StructField("ts", T.LongType()),  # epoch milliseconds
        T.StructField("page", T.StringType()),
        T.StructField("level", T.StringType()),
        T.StructField("song", T.StringType()),
        T.StructField("artist", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("itemInSession", T.LongType()),
        T.StructField("length", T.DoubleType()),
        T.StructField("location", T.StringType()),
        T.StructField("status", T.LongType()),
        T.StructField("userAgent", T.StringType()),
    ]
)
ACTIVITY_COLUMNS = ACTIVITY.fieldNames()

# Page names as the application logs them, keyed by the 0/1 flag
# each one sets; the level of a paying user; the page behind most events.
PAGE_FLAGS = {
    "churn": "Cancellation Confirmation",
    "downgradeVisit": "Downgrade",
    "downgradeSubmit": "Submit Downgrade",
    "addToPlaylist": "Add to Playlist",
    "addFriend": "Add Friend",
    "rollAdvert": "Roll Advert",
    "logout": "Logout",
    "listeningSongs": "NextSong",
    "Up": "Thumbs Up",
    "Down": "Thumbs Down",
}
PAID_LEVEL = "paid"
SONG_PAGE = "NextSong"

# Names of the per-user sums, keyed to the flag they add up.
USER_TOTALS = {
    "downgradeVisited": "downgradeVisit",
    "downgradeSubmitted": "downgradeSubmit",
    "songsListened": "listeningSongs",
    "songsAddedToPlaylist": "addToPlaylist",
    "friendsAdded": "addFriend",
    "rolledAdverts": "rollAdvert",
    "logouts": "logout",
    "DownVoted": "Down",
    "UpVoted": "Up",
}

# Rate name -> (what is counted, per what).
RATES = {
    "songsListenedPerDay": ("songsListened", "daysInteracting"),
    "songsAddedToPlaylistPerDay": ("songsAddedToPlaylist", "daysInteracting"),
    "friendsAddedPerDay": ("friendsAdded", "daysInteracting"),
    "rolledAdvertsPerDay": ("rolledAdverts", "daysInteracting"),
    "logoutsPerDay": ("logouts", "daysInteracting"),
    "upVotedPerDay": ("UpVoted", "daysInteracting"),
    "DownVotedPerDay": ("DownVoted", "daysInteracting"),
    "DownVotedPerSong": ("DownVoted", "songsListened"),
    "UpVotedPerSong": ("UpVoted", "songsListened"),
    "rolledAdvertsPerSong": ("rolledAdverts", "songsListened"),
}

# Change ratio -> the rate whose last week it compares with before.
CHANGES = {
    "playlistActivityChange": "songsAddedToPlaylistPerDay",
    "listeningActivityChange": "songsListenedPerDay",
}

# Look-back dates and the number of days each lies before a
# user's last day. The first one separates the two segments.
LOOKBACKS = {
    "weekBeforeEndDate": 7,
    "twoweekBeforeEndDate": 14,
    "threeweekBeforeEndDate": 21,
    "fourweekBeforeEndDate": 28,
}

# The measures compared between cohorts, and the model's inputs.
VOLUME_METRICS = [
    "songsListenedPerDay",
    "songsAddedToPlaylistPerDay",
    "friendsAddedPerDay",
    "rolledAdvertsPerDay",
]
RATIO_METRICS = [
    "logoutsPerDay",
    "DownVotedPerSong",
    "UpVotedPerSong",
    "rolledAdvertsPerSong",
]
INTENSITY_METRICS = ["intensityOfInteraction"]
MODEL_FEATURES = [
    "songsListenedPerDay",
    "DownVotedPerSong",
    "friendsAddedPerDay",
    "intensityOfInteraction",
    "playlistActivityChange",
    "listeningActivityChange",
]

# A segment is a slice of each user's own history; its columns carry the suffix.
SEGMENTS = {
    "all": "",
    "last_week": "LastWeek",
    "before_last_week": "BeforeLastWeek",
}


def segment_suffix(segment: str) -> str:
    """Column suffix of a segment; unknown names are an error, not a default."""
    if segment not in SEGMENTS:
        raise ValueError(f"unknown segment {segment!r}; expected one of {sorted(SEGMENTS)}")
    return SEGMENTS[segment]
