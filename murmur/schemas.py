"""Schemas of the tables and payloads, as DDL strings."""

REDDIT_POSTS = (
    "post_id string, subreddit string, data string, last_comment_id string, "
    "last_comment_update timestamp_ntz, cleaned_title string, cleaned_text string, "
    "title_score double, title_class string"
)
REDDIT_COMMENTS = (
    "subreddit string, post_id string, comment_id string, data string, is_deleted boolean"
)
REDDIT_COMMENTS_CLEANED = (
    "id string, post_id string, parent_id string, data string, cleaned_text string, "
    "score double, class string"
)
CHAN_POSTS = (
    "id long, post_number long, thread_number long, board string, data string, "
    "created_at long, score double, class string, cleaned_text string"
)

# JSON members exposed as typed columns when a table is loaded: column -> (members, type).
# The first member present wins.
POST_FIELDS = {
    "author": (("author",), "string"),
    "votes": (("score",), "int"),
    "ups": (("ups",), "int"),
    "title": (("title",), "string"),
    "selftext": (("selftext",), "string"),
    "created": (("created_utc", "created"), "epoch"),
}
COMMENT_FIELDS = {
    "author": (("author",), "string"),
    "body": (("body",), "string"),
    "reply_to": (("parent_id",), "string"),
    "created": (("created_utc", "created"), "epoch"),
}
CHAN_FIELDS = {
    "created": (("time",), "epoch"),
    "replies": (("replies",), "int"),
    "resto": (("resto",), "int"),
}

# Payload files dropped by a crawler: one JSON object per line.
CATALOG_FILE = "board string, snapshot_at long, payload string"
THREAD_FILE = "board string, thread_number long, payload string"
LISTING_FILE = "subreddit string, post_id string, fetched_at long, payload string"
