"""Fixed values of the data model, kept together so that results stay comparable."""

# Namespaces of the conformed and of the star-schema tables.
SILVER = "silver"
GOLD = "gold"

# Statuses, asset types, period types, source types, the view platform.
ACTIVE = "ACTIVE"
INACTIVE = "INACTIVE"
VIDEO = "VIDEO"
TRACK = "TRACK"
DAILY = "DAILY"
MONTHLY = "MONTHLY"
YOUTUBE = "YOUTUBE"
DISTRIBUTOR = "DISTRIBUTOR"
VIEW_PLATFORM = "PLT_YTB"
EQUAL = "EQUAL"

# Bounds of the calendar dimension.
CALENDAR_START = "2024-01-01"
CALENDAR_END = "2026-12-31"

# Exact money. Sums of doubles depend on the order in which rows arrive, sums of
# decimals do not, so amounts stay decimal in every table. USD holds any MONEY times any
# FX_RATE, rounded half up to 8 decimals; USD times SHARE is exact in 38 digits, so sums of USD are cast
# back to USD before they are split (a sum of 10^20 or more is an error, not a rounded amount).
MONEY = "decimal(18,6)"  # amounts as reported
FX_RATE = "decimal(18,10)"  # currency conversion
VIEW_RATE = "decimal(12,8)"  # payment per view
USD = "decimal(28,8)"  # converted amount of one row
SHARE = "decimal(9,6)"  # part of an asset's revenue, 0..1

# Platforms (id, name, type).
PLATFORMS = [
    ("PLT_SPF", "Spotify", "STREAMING"),
    ("PLT_APM", "Apple Music", "STREAMING"),
    ("PLT_TTK", "TikTok", "STREAMING"),
    ("PLT_SCL", "SoundCloud", "STREAMING"),
    ("PLT_YTM", "YouTube Music", "STREAMING"),
    ("PLT_YTB", "YouTube", "VIDEO"),
]

# Distributors (id, name, payment cycle, status).
DISTRIBUTORS = [
    ("DST_RTN", "Routenote", "Monthly", "ACTIVE"),
    ("DST_LDR", "LANDR", "Monthly", "ACTIVE"),
    ("DST_DTO", "Ditto", "Monthly", "ACTIVE"),
    ("DST_TNC", "Tunecore", "Monthly", "ACTIVE"),
    ("DST_OPM", "ONERPM", "Monthly", "ACTIVE"),
    ("DST_WMG", "WMG", "Monthly", "ACTIVE"),
]

# USD per stream by platform.
STREAM_RATES = {
    "PLT_SPF": "0.003",
    "PLT_APM": "0.005",
    "PLT_TTK": "0.0005",
    "PLT_SCL": "0.0025",
    "PLT_YTM": "0.002",
}

# Country (code, name, USD per view, weight in partner revenue).
COUNTRIES = [
    ("VN", "Vietnam", "0.0005", 30),
    ("US", "United States", "0.004", 20),
    ("GB", "United Kingdom", "0.0038", 10),
    ("JP", "Japan", "0.003", 8),
    ("KR", "South Korea", "0.0025", 8),
    ("TH", "Thailand", "0.001", 6),
    ("ID", "Indonesia", "0.0008", 6),
    ("MY", "Malaysia", "0.001", 4),
    ("SG", "Singapore", "0.003", 3),
    ("PH", "Philippines", "0.0008", 3),
    ("AU", "Australia", "0.0035", 3),
    ("FR", "France", "0.003", 3),
    ("DE", "Germany", "0.003", 3),
    ("BR", "Brazil", "0.001", 3),
    ("MX", "Mexico", "0.001", 2),
    ("IN", "India", "0.0007", 2),
    ("CA", "Canada", "0.0035", 2),
    ("IT", "Italy", "0.0028", 2),
    ("ES", "Spain", "0.0025", 2),
    ("NL", "Netherlands", "0.003", 2),
]

# Words of our own for the generated master data.
PROJECTS = ["Harbour", "Lantern", "Meadow", "Orchard", "Quarry", "Tidewater"]
ROLES = [
    "Lyricist",
    "Session Player",
    "Vocal Coach",
    "Beat Maker",
    "Camera",
    "Lighting",
    "Stage Crew",
    "Cover Artist",
    "Booking",
    "Licensing",
]
TEAMS = ["Studio", "Stage", "Film", "Rights", "Press"]
CONTENT_TYPES = ["Official Clip", "Text Clip", "Concert", "Rehearsal", "Teaser"]

# Sizes and ranges of the generated data.
TRACK_COUNT = 3000
ARTIST_COUNT = 500
CONTRIBUTOR_COUNT = 50
CHANNEL_COUNT = 10
VIDEO_COUNT = 300
FIRST_MONTH = "2025-01-01"
MONTH_COUNT = 24
VIEW_DAYS = 720

# Names of our own for the generated labels.
LABELS = ["Label North", "Label South", "Label East", "Label West", "Label Centre"]
