"""Silver and gold models, metric queries, account review and reports."""
