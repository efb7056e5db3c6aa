"""Retail-transaction analytics expressed as Spark DataFrame plans.

Layers: raw file -> bronze -> silver -> star schema and marts -> churn scoring, segmentation and monitoring.
"""
