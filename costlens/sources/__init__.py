"""Readers: run trees and manifests, fact Parquet, price JSON, system metadata, price-list documents."""
