"""KPI tables, profiles, report series and the monthly run."""
