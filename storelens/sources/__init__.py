"""Store contracts, workbook scans, staging and snapshot tables."""
