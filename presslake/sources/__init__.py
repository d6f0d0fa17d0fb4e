"""Readers: seed lists, sitemap XML, crawl tables, batch-job files, dated snapshots."""
