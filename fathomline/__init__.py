"""Spark jobs for financial-crime analytics: customer features, money flow, communities, risk and news."""
