"""Analytics over changelogs of shop-floor production reports, as DataFrame transformations."""
