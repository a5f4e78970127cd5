"""The published codebook: six dimensions, 36 indicators."""

from __future__ import annotations

#: What a missing signal means by the status of its collection; then what it means without a status.
_ZERO = {"kind": "conditional", "states": {"absent": "zero", "unreachable": "exclude", "forbidden": "exclude"}, "default": "zero"}
_OFFER = {"kind": "conditional", "states": {"absent": "zero", "unreachable": "exclude", "forbidden": "exclude", "not_applicable": "skip"}, "default": "skip"}
_AUDIT = {"kind": "conditional", "states": {"absent": "skip", "unreachable": "exclude", "forbidden": "exclude"}, "default": "skip"}
_SKIP = {"kind": "skip"}

#: Grades of consent dialogues.
_CONSENT = {"none": 0, "informational_only": 20, "accept_only": 35, "reject_equal_prominence": 85, "granular_with_revoke": 100}

#: Dimension, its weight, and per indicator: id, signal, weight, policy for missing values.
_BOOL = (
    ("legal_compliance", 0.28, (
        ("impressum", "legal.impressum.present", 0.25, _ZERO), ("datenschutz", "legal.datenschutz.present", 0.25, _ZERO), ("agb", "legal.agb.present", 0.15, _ZERO),
        ("bfsg", "legal.bfsg.present", 0.1, _ZERO), ("widerruf", "legal.widerruf.present", 0.1, _OFFER), ("versand", "legal.versand.present", 0.1, _OFFER),
        ("consent_quality", "privacy.consent.quality", 0.05, _OFFER),
    )),
    ("contact_accessibility", 0.22, (
        ("contact_form", "contact.form.present", 0.3, _ZERO), ("opening_hours", "content.opening_hours.present", 0.2, _ZERO), ("map", "content.map.present", 0.15, _SKIP),
        ("team_page", "content.team_page.present", 0.15, _SKIP), ("portfolio", "content.portfolio.present", 0.1, _SKIP), ("testimonials", "content.testimonials.present", 0.1, _SKIP),
    )),
    ("structured_data", 0.18, (
        ("local_business", "structured_data.schema_org.local_business.present", 0.3, _ZERO), ("faq", "structured_data.schema_org.faq.present", 0.15, _SKIP),
        ("review", "structured_data.schema_org.review.present", 0.15, _SKIP), ("service", "structured_data.schema_org.service.present", 0.15, _SKIP),
        ("breadcrumb", "structured_data.schema_org.breadcrumb.present", 0.1, _SKIP), ("product", "structured_data.schema_org.product.present", 0.15, _OFFER),
    )),
    ("trust_signals", 0.12, (
        ("certifications", "trust.certifications.present", 0.25, _ZERO), ("meister", "trust.certification.meister.present", 0.25, _ZERO), ("awards", "trust.awards.present", 0.15, _SKIP),
        ("memberships", "trust.memberships.present", 0.15, _SKIP), ("handelsregister", "registry.handelsregister.present", 0.1, _SKIP), ("google_business", "registry.google_business.present", 0.1, _SKIP),
    )),
    ("social_presence", 0.04, (
        ("facebook", "social.facebook.present", 0.2, _ZERO), ("instagram", "social.instagram.present", 0.2, _ZERO), ("youtube", "social.youtube.present", 0.15, _SKIP),
        ("linkedin", "social.linkedin.present", 0.15, _SKIP), ("tiktok", "social.tiktok.present", 0.1, _SKIP), ("whatsapp", "social.whatsapp.present", 0.1, _SKIP), ("xing", "social.xing.present", 0.1, _SKIP),
    )),
)
#: Violations by impact, their weight, and the count at which the score is 0.
_IMPACTS = (("critical", 0.4, 5), ("serious", 0.3, 10), ("moderate", 0.2, 20), ("minor", 0.1, 30))


def _rule(key: str) -> dict:
    return {"type": "enum", "cases": _CONSENT, "defaultScore": 0} if key == "privacy.consent.quality" else {"type": "bool"}


PUBLISHED = {
    "id": "observatory", "version": "1.3.0",
    "dimensions": [
        {"id": d, "weight": w, "indicators": [{"id": i, "inputKey": k, "weight": x, "rule": _rule(k), "missing": m} for i, k, x, m in rows]} for d, w, rows in _BOOL
    ] + [{"id": "accessibility_audit", "weight": 0.16, "indicators": [
        {"id": f"axe_{n}", "inputKey": f"audit.axe.violations.{n}.count", "weight": w, "rule": {"type": "countClampInverse", "min": 0, "max": most}, "missing": _AUDIT} for n, w, most in _IMPACTS
    ]}],
}
