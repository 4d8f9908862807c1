"""Plan-level building blocks: distributed ordered scans, catalog, inspection."""
