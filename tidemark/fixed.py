"""Names, formats, limits and defaults that users and stored data rely on."""

# Names of the values recorded per file.
METRIC_NAMES = (
    "created_on",
    "size_bytes",
    "seen_on",
    "transferred_on",
    "transfer_retries",
    "transfer_time",
    "total_uploaded_files",
)

# Encrypted files.
ENCRYPTED_SUFFIX = ".pgp"
PLAIN_TYPE = "application/octet-stream"
ENCRYPTED_TYPE = "application/pgp-encrypted"

# Names of buckets; no slash, no capitals.
BUCKET_PATTERN = r"[a-z0-9\-_.]+"

# Windows, in seconds.
DEFAULT_SAFETY_S = 300
WATERMARK_DIGITS = 10

# Transfers: waits in seconds, buffers in bytes.
DEFAULT_PORT = 22
DEFAULT_RETRIES = 3
DEFAULT_WAIT_S = 30
MAX_RETRIES = 100
MAX_WAIT_S = 300
BUFFER_BYTES = 15 * 1024 * 1024
