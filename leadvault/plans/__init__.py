"""The marketing model: staging, vault, campaigns, lead mart, dashboards, and their order."""
