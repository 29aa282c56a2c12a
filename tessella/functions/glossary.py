"""The glossary: categories and their terms, in declared order."""

from __future__ import annotations

# Categories and terms.
GLOSSARY: dict[str, list[str]] = {
    "core_mechanics_strength": [
        "சுபத்துவம் (Subathuvam)", "பாபத்துவம் (Pabathuvam)", "சுப கிரகம்", "பாப கிரகம்",
        "சூட்சும வலு (Sookshuma Valu)", "ஸ்தூல வலு", "ஷட்பலம்", "ஸ்தான பலம்",
        "திக்பலம்", "கால பலம்", "சேஷ்டா பலம்", "நைசர்கிக பலம்", "த்ரிக் பலம்"
    ],
    "houses_bhava_system": [
        "லக்னம் (Lagnam)", "பாவம்", "பாவாதிபதி", "கேந்திரம் (Kendram)", "திரிகோணம் (Thrikonam)",
        "உபசய ஸ்தானம்", "மறைவு ஸ்தானம் (Maraivu Sthanam)", "மாரக ஸ்தானம்", "பாதக ஸ்தானம்",
        "அஷ்டம பாவம்", "துவாதச பாவம்"
    ],
    "planets_and_states": [
        "நவகிரகம்", "சூரியன்", "சந்திரன்", "செவ்வாய் (Kuja/Chevvai)", "புதன்", "குரு", "சுக்கிரன்", "சனி", "ராகு", "கேது",
        "உச்சம் (Utcham)", "நீசம் (Neecham)", "ஸ்வக்ஷேத்திரம்", "மூல திரிகோணம்", "மித்ர க்ஷேத்திரம்",
        "சத்ரு க்ஷேத்திரம்", "வக்கிரம் (Vakkiram)", "அஸ்தமனம் (Asthamanam)", "கிரஹ யுத்தம்"
    ],
    "yogas_and_linking": [
        "ராஜயோகம்", "தரித்ர யோகம்", "கஜகேசரி யோகம்", "சண்டால யோகம்", "நீசபங்க ராஜயோகம்",
        "பரிவர்த்தனை யோகம் (Parivarthanai)", "விபரீத ராஜயோகம்", "அதி யோகம்", "தர்ம கர்மாதிபதி யோகம்",
        "சம்பந்தம் (Sambandham)", "பரஸ்பர சம்பந்தம்", "த்ரிஷ்டி சம்பந்தம்", "சேர்க்கை",
        "ஆதார கிரகம்", "இயக்க கிரகம்", "பலன் தரும் கிரகம்"
    ],
    "divisional_charts": [
        "ராசி", "நவாம்சம் (Navamsam)", "த்ரேக்காணம்", "தசாம்சம்", "சப்தாம்சம்", "ஷோடஷாம்சம்",
        "விம்ஷாம்சம்", "சதுர்விம்சாம்சம்", "திரிம்சாம்சம்", "வர்க்கோத்தமம் (Vargothamam)"
    ],
    "time_and_transit": [
        "விம்சோத்தரி தசா", "தசா", "புக்தி (Bhukti)", "அந்தரம்", "பிரத்யந்தரம்", "சூட்சுமம்",
        "கோச்சாரம் (Gocharam)", "சடே சதி", "அஷ்டம சனி", "நக்ஷத்திரம்", "பதம்", "ஆதிபதி",
        "ஜனம நக்ஷத்திரம்", "தார பலம்", "சந்திர பலம்"
    ],
    "roles_and_math": [
        "அஷ்டகவர்க்கம் (Ashtakavargam)", "பிண்டம்", "ரேகை", "சர்வாஷ்டகவர்க்கம்",
        "யோககாரகன் (Yogakarakan)", "மாரகன்", "பாதகன்", "பாக்கியாதிபதி", "அஷ்டமாதிபதி",
        "லக்னாதிபதி", "காரகன்", "ஆத்ம காரகன்", "அமாத்ய காரகன்"
    ],
    "special_subtle_concepts": [
        "அருட்கடாசம் (Arudha Lagna)", "உபபாத லக்னம்", "குலிகன்", "மாந்தி", "யமகண்டம்",
        "ராகுகாலம்", "அபிஜித் முகூர்த்தம்", "முகூர்த்தம்", "நாடி ஜோதிடம்", "சூட்சும பார்வை",
        "ஜீவ காரகன்", "சரீர காரகன்", "கர்ம வாசனை", "கர்ம பலன்", "ருணம்", "ருண அனுபவம்"
    ],
    "event_triggers_psychology": [
        "நிகழ்வு தொடக்கம்", "பலன் வெளிப்பாடு", "கால இயக்கம்", "தசா செயற்பாடு", "கோச்சார தூண்டல்",
        "சுப-பாப கலப்பு பலன்", "தீவிர பலன்", "மன நிலை", "எண்ண ஓட்டம்", "பய அனுபவம்",
        "ஆசை இயக்கம்", "பற்றுதல்", "மூல காரணம்", "மேலோட்ட பலன்", "உள்ளார்ந்த பலன்",
        "வெளிப்புற சூழ்நிலை", "உள் கர்ம இயக்கம்", "பலன் குறைவு", "பலன் அதிகம்",
        "தடைப்பட்ட பலன்", "தாமத பலன்", "திடீர் பலன்", "மறைமுக பலன்"
    ]
}
# The terms used where a title matches none.
CORE_TERMS = "சுபத்துவம், லக்னம், நவகிரகம், தசா புக்தி"
