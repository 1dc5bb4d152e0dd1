"""Ad-performance analytics as PySpark DataFrame functions.

Layers: landed reports -> bronze (natural-key upsert) -> silver (latest-wins,
typed) -> gold (KPI tables) -> metric queries, account review and signals.
"""
