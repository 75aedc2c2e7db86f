"""Labels that results carry (fixed values)."""

# Recommended action of the health dashboard
ACTION = {
    "executive": "URGENT: Executive outreach needed",
    "call": "Schedule CSM call immediately",
    "check_in": "Proactive check-in recommended",
    "training": "Low usage - offer training",
    "re_engage": "No recent activity - re-engagement needed",
    "tickets": "Multiple open tickets - prioritize resolution",
    "none": "Healthy - maintain relationship",
}
# Risk summary of the at-risk function
RISK = {
    "high_value": "URGENT: High-value account at critical risk",
    "critical": "Critical risk - immediate outreach needed",
    "declining": "Declining health - proactive intervention recommended",
    "quiet": "Low engagement - reactivation campaign suggested",
    "other": "At risk - monitor closely",
}
# Health status of the customer profile, and of the gold layer
PROFILE = {"churned": "Churned", "healthy": "Healthy", "attention": "Needs Attention", "risk": "At Risk"}
GOLD = {"healthy": "HEALTHY", "risk": "AT RISK", "critical": "CRITICAL"}
QUALITY = {"valid": "VALID", "bad_score": "INVALID_HEALTH_SCORE"}
# Sentiment beside score, and ticket escalation
MOOD = {"clash": "Review needed - mismatch", "aligned": "Aligned", "escalate": "Escalation Risk", "watch": "Monitor Closely", "normal": "Normal"}
# Quota, projection, budget and anomaly status
QUOTA = {"critical": "🔴 CRITICAL", "warning": "🟡 WARNING", "on_track": "🟢 ON TRACK", "healthy": "✅ HEALTHY"}
PROJECTION = {"over": "⚠️ OVER BUDGET", "within": "✅ WITHIN BUDGET"}
BUDGET = {"over": "🔴 OVER BUDGET", "risk": "🟡 AT RISK", "projected": "⚠️ PROJECTED OVER", "fine": "🟢 ON TRACK"}
ANOMALY = {"extreme": "🔴 EXTREME", "high": "🟡 HIGH", "normal": "🟢 NORMAL"}
