"""Business constants."""

# Fixed values.
TIMEZONE = "Asia/Shanghai"
SHIFT_MINUTES = 510  # the shift day starts at 08:30
EXCLUDED_PREFIX = "FG"
DATASOURCES = {"mes_old_": "OLD_MES", "mes_new_": "NEW_MES"}
SITES = ("zh", "zz", "hf", "wh", "cq")
CHANNELS = {"lot": "MANUAL", "barcodeautomatic": "BARCODE"}
LEVELS = ("NONE", "P3", "P2", "P1")
OVER_RATIO, LAG_THRESHOLD = 1.0, 0.2
IDLE_SECONDS, ESCALATE_SECONDS, SNAPSHOT_SECONDS = 3600, 600, 10
DIGEST_ITEMS, DIGESTS_PER_MINUTE = 20, 18
TOLERANCE = 0.005
WATERMARK_SECONDS, LATENESS_SECONDS = 60, 120
STATE_TTL_MS = 7 * 24 * 3600 * 1000
DATABASES = tuple(f"mes_{age}_{site}" for age in ("old", "new") for site in SITES)
