"""Texts of the narratives, held apart from those of the package."""

# Factor labels and advice texts.
LABELS = {
    "otd_rate_90d": "On-Time Delivery Degradation",
    "avg_variance_days": "Excess Delivery Delay Variance",
    "std_variance_days": "Lead-Time Volatility",
    "defect_ppm_90d": "Elevated Defect PPM Rate",
    "financial_risk_score": "Supplier Financial Distress",
    "single_source_count": "Single-Source Material Bottleneck",
    "overdue_po_count": "Overdue PO Order Backlog",
    "days_of_inventory": "Depleted Days of Inventory (DOI)",
    "safety_stock_ratio": "Safety Stock Threshold Breach",
    "is_critical": "Critical Path BOM Component",
    "total_shortage_units": "Active Work Order Shortage",
}
SUPPLIER_ADVICE = {
    "CRITICAL": "IMMEDIATE MITIGATION: Dual-source critical parts immediately, enforce mandatory lot quality "
    "inspections, and issue formal supplier corrective action request (SCAR).",
    "HIGH": "RECOMMENDED ACTION: Expedite buffer stock orders, increase incoming QC sample rates, and schedule "
    "operational review with vendor leadership.",
    "MEDIUM": "MONITOR: Track next 3 inbound shipments for lead-time stabilization and verify quality certs.",
    "LOW": "MAINTAIN: Supplier operating within acceptable tolerances. Eligible for preferred vendor rebate tiers.",
}
