"""Sources: file readers and adapters over the driver's tables."""
